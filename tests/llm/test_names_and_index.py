"""Columns of the user's that are named like the operators' own stay as they are; an index reopens with its own buckets."""

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.exact_dedup import DigestIndex, digests_of, drop_copies
from ledgerline.llm.mixing import mixed_documents
from ledgerline.llm.ngram_join import drop_near_copies
from ledgerline.llm.quality import keep_good
from ledgerline.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, _id string, _DIGEST string, _h string, _copy string, __id string"
TEXTS = ["one two three four five six seven", "one two three four five six seven", "alpha beta gamma delta epsilon zeta", "red green blue black white grey"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", f"s{i % 2}", f"a{i}", f"b{i}", f"c{i}", f"d{i}", f"e{i}") for i, t in enumerate(TEXTS)], SCHEMA).repartition(2)


def own(r):
    return (r["_id"], r["_DIGEST"], r["_h"], r["_copy"], r["__id"]) == tuple(f"{x}{r['doc_id']}" for x in "abcde")


def test_user_columns_stay(spark, docs):
    labels = spark.createDataFrame([(0, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for out, ids in ((drop_copies(docs), [1, 2, 3]), (drop_near_copies(docs), [0, 2, 3]), (keep_good(docs, labels), None), (mixed_documents(docs), None)):
        rows = out.collect()
        assert out.columns == docs.columns and rows and all(own(r) for r in rows)
        assert ids is None or sorted(r.doc_id for r in rows) == ids


def test_index_reopens_with_its_own_buckets(spark, docs):
    path = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    many = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    first = DigestIndex(spark, path, buckets=4)
    first.append(digests_of(many))
    assert first.read().count() == 200
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "7")
    again = DigestIndex(other, path)
    assert again.buckets == 4
    more = other.range(150, 260).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    again.append(digests_of(more))
    assert again.read().count() == 260
    assert DigestIndex(spark, path, buckets=9).buckets == 4
    assert again.read().groupBy("digest").count().where("count > 1").count() == 0
