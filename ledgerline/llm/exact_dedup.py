"""Exact dedup (4): a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table bucketed and sorted by the text digest. A batch
is digested, deduplicated within itself, held against the index by a
sort-merge anti-join (the index side is read bucket by bucket, without a
shuffle), and what is new is appended. Only DataFrame functions are used.

Defined cases: a null text is the empty text; a null doc_id orders after every
other id, so it stays when its group has one; rows repeated whole share one
group and both count in ``group_size``; an empty batch appends nothing; further
columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import free_names, give_back_ids, id_and_text, keep_table, partitions
from ledgerline.session import checkpoint_dir, scratch_path

# A digest that holds more than 1/HOT_SHARE of the rows is "hot"; there are at
# most HOT_SHARE of them, whatever the data, so that list may be broadcast.
HOT_SHARE = 1000


class DigestIndex:
    """A named index table: ``digest`` binary, ``keep_id`` long, ``group_size`` long.

    Its number of buckets is kept beside the data (an empty file ``_buckets_<n>``): whoever opens the path
    again, in whatever session, uses that number."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        checkpoint_dir(spark)
        self.table = f"digest_index_{uuid.uuid4().hex}"
        self.path = path or scratch_path(spark, self.table)
        self.spark, self.buckets = spark, self._stored(spark, buckets or partitions(spark))
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, group_size BIGINT) USING parquet "
                  f"OPTIONS (path '{self.path}') CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS")

    def _stored(self, spark: SparkSession, wanted: int) -> int:
        """The number of buckets of what lies at the path; ``wanted``, noted there, if there is nothing yet."""
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        found = files.globStatus(path(f"{self.path}/_buckets_*"))
        if found:
            return int(found[0].getPath().getName().rpartition("_")[2])
        files.create(path(f"{self.path}/_buckets_{wanted}"), True).close()
        return wanted

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, digests: DataFrame) -> None:
        """Add the digests of ``digests`` (doc_id, digest) that the index lacks;
        the largest doc_id of a batch represents its text."""
        # stored first: Spark would push the anti-join below the sums and shuffle every copy of a text to one task
        batch = keep_table(digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "batch")
        new = batch.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .select("digest", "keep_id", "group_size")
         .write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))


def digests_of(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the text, 32 bytes."""
    return id_and_text(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))


def lookup(digests: DataFrame, index: DigestIndex) -> DataFrame:
    """Each row of ``digests`` with the ``keep_id`` and ``group_size`` of its text.

    Rows of hot digests meet the (at most ``HOT_SHARE``) hot index rows in a
    broadcast join; the others are sort-merged with the bucketed index, so no
    task gathers a group that holds a large share of the rows."""
    total = digests.count()
    hot = F.broadcast(index.read().where(F.col("group_size") * HOT_SHARE > F.lit(total))
                      .select("digest", F.struct("keep_id", "group_size").alias("hot")))
    seen = digests.join(hot, "digest", "left")
    cold = (seen.where(F.col("hot").isNull()).select("doc_id", "digest")
            .join(index.read().hint("merge"), "digest"))
    return (seen.where(F.col("hot").isNotNull())
            .select("digest", "doc_id", F.col("hot.keep_id").alias("keep_id"), F.col("hot.group_size").alias("group_size"))
            .unionByName(cold))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Rows repeated whole (one doc_id, one text) share their lot: all of them are kept where that doc_id stays;
    :func:`drop_copies` leaves one.

    With a fresh index (the default) the whole table is one batch. With an
    index that already holds texts, those keep their earlier representative,
    and rows with such a text come back as not kept."""
    spark = docs.sparkSession
    digests = keep_table(digests_of(docs), "digests")
    index = index or DigestIndex(spark)
    index.append(digests)
    out = lookup(digests, index).withColumn("kept", F.col("doc_id") == F.col("keep_id")) \
        .withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")
    return give_back_ids(out, "doc_id", "keep_id").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row left of each group of equal texts: of the rows
    with the largest doc_id, one (a doc_id can repeat)."""
    row, own = free_names(docs, "_digest", "_id")
    d = docs.withColumn(row, F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))) \
            .withColumn(own, F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)))
    index = DigestIndex(docs.sparkSession)
    index.append(keep_table(d.select(F.col(own).alias("doc_id"), F.col(row).alias("digest")), "digests"))
    win = index.read().select(F.col("digest").alias(row), F.col("keep_id").alias(own))
    # only the representatives' rows remain before rows of one (digest, id) are reduced to one
    return d.join(win, [row, own], "left_semi").dropDuplicates([row, own]).select(*docs.columns)
