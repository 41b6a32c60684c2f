"""Registered queries of this package (op1 ... op13) and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import documents


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, repeating; ``shards`` counts the output shards that hold some of a document."""
    from ledgerline.llm.mixing import taken_words
    return taken_words(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: patterns, and what the trained tagger adds."""
    from ledgerline.llm.pii import find_pii
    return find_pii(documents(spark, sf_dir))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 5-word shingle sets link at Jaccard 0.75 or more."""
    from ledgerline.llm.ngram_join import jaccard_groups
    return jaccard_groups(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    from ledgerline.llm.exact_dedup import exact_dedup
    return exact_dedup(documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without 50-byte strings of documents with smaller ids."""
    from ledgerline.llm.suffix_dedup import suffix_dedup
    return suffix_dedup(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's place in sequences of at most 4096 tokens."""
    from ledgerline.llm.packing import pack
    return pack(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it stays."""
    from ledgerline.llm.quality import classify
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(documents(spark, sf_dir), labels).drop("h")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without 20-word windows that start earlier."""
    from ledgerline.llm.substring_dedup import substring_dedup
    return substring_dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: patterns, and tokens that test as random."""
    from ledgerline.llm.secrets import scan_secrets
    return scan_secrets(documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-syncmer fingerprints of every text and its edited text, and their likeness."""
    from ledgerline.llm.fingerprints import fingerprints
    return fingerprints(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each anchor's positives with their hardest negatives inside the score window."""
    from ledgerline.llm.hard_negatives import hard_negatives
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every usable vector, with the exact squared deviation."""
    from ledgerline.llm.whitening import whiten
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document."""
    from ledgerline.llm.toxicity import score_toxicity
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op1_mix": op1_mix, "op2_pii": op2_pii, "op3_jaccard_join": op3_jaccard_join, "op4_exact_dedup": op4_exact_dedup,
           "op5_suffix_dedup": op5_suffix_dedup, "op6_pack": op6_pack, "op7_quality": op7_quality,
           "op8_substring_dedup": op8_substring_dedup, "op9_secrets": op9_secrets, "op10_fingerprints": op10_fingerprints,
           "op11_hard_negatives": op11_hard_negatives, "op12_whiten": op12_whiten, "op13_toxicity": op13_toxicity}

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op1_mix": f"""
        WITH s AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
        src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM s GROUP BY source),
        w AS (SELECT *, CAST(sid % 3 + 1 AS BIGINT) AS w, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM src),
        f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                     sum(w) OVER (ORDER BY cap / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_from FROM w),
        c AS (SELECT *, cap * w_from <= w * (total - before) AS capped FROM f),
        l AS (SELECT *, total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS rest,
                     coalesce(sum(CASE WHEN NOT capped THEN w END) OVER (), 1) AS free FROM c),
        t AS (SELECT source, sid, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST(w * rest AS DOUBLE) / free END AS target FROM l),
        q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS take, CAST(ceil(source_size / 4096.0) AS BIGINT) AS n_blocks FROM t),
        p AS (SELECT *, CASE WHEN source_size > 0 THEN take // source_size ELSE 0 END AS passes FROM q),
        b AS (SELECT sid, n_blocks, source_size, passes, take - passes * source_size AS rest_words, unnest(range(n_blocks)) AS block FROM p),
        r AS (SELECT *, least(4096, source_size - block * 4096) AS words,
                     row_number() OVER (PARTITION BY sid ORDER BY md5(concat_ws(':', sid, passes, block)), block) AS k FROM b),
        d AS (SELECT sid, block, greatest(0, least(words, rest_words - (sum(words) OVER (PARTITION BY sid ORDER BY k) - words))) AS drawn FROM r),
        a AS (SELECT s.doc_id, s.size, p.source_size, p.target, p.passes, p.sid,
                     sum(s.size) OVER (PARTITION BY p.sid ORDER BY md5(CAST(s.doc_id AS VARCHAR)), s.doc_id) - s.size AS at
              FROM s JOIN p ON s.source IS NOT DISTINCT FROM p.source),
        o AS (SELECT a.doc_id, sum(greatest(0, least(a.at + a.size, d.block * 4096 + d.drawn) - greatest(a.at, d.block * 4096))) AS part
              FROM a JOIN d ON a.sid = d.sid AND d.block * 4096 < a.at + a.size AND (d.block + 1) * 4096 > a.at GROUP BY a.doc_id)
        SELECT a.doc_id, a.size, a.source_size, a.target, CAST(a.passes * a.size + coalesce(o.part, 0) AS BIGINT) AS taken
        FROM a LEFT JOIN o ON a.doc_id = o.doc_id""",
    "op8_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        n AS (SELECT doc_id, words, len(words) AS n FROM w),
        x AS (SELECT doc_id, unnest(range(n - 19)) AS start, words FROM n WHERE n >= 20),
        h AS (SELECT doc_id, start, md5(array_to_string(words[start + 1:start + 20], ' ')) AS key FROM x),
        l AS (SELECT doc_id, start, row_number() OVER (PARTITION BY key ORDER BY doc_id, start) > 1 AS late FROM h),
        g AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS i FROM l WHERE late),
        e AS (SELECT doc_id, words[i + 1] AS word, i FROM (SELECT doc_id, words, unnest(range(n)) AS i FROM n)),
        k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept, count(*) AS n_kept
              FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.i = g.i WHERE g.i IS NULL GROUP BY e.doc_id)
        SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_words, CAST(n.n - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(k.kept, '')) AS kept_sha256
        FROM n LEFT JOIN k ON n.doc_id = k.doc_id""",
    "op3_jaccard_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x20\x09-\x0D]+') AS words FROM documents),
        g AS (SELECT DISTINCT doc_id, md5(array_to_string(words[i + 1:i + 5], ' ')) AS gram
              FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - 4, 1))) AS i FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * n_both >= 75 * (a.n + b.n - n_both)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r AS (SELECT DISTINCT x AS doc_id, x AS seen FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen),
        c AS (SELECT doc_id, min(seen) AS low FROM r GROUP BY doc_id)
        SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.low, w.doc_id) AS component_id
        FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN c ON w.doc_id = c.doc_id""",
    "op5_suffix_dedup": """
        WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
        n AS (SELECT doc_id, x, len(x) // 2 AS n FROM d),
        s AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 100)) AS key FROM (SELECT doc_id, x, unnest(range(n - 49)) AS i FROM n WHERE n >= 50)),
        l AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY key) AS low FROM s) WHERE low < doc_id),
        o AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM l),
        p AS (SELECT doc_id, i, sum(CASE WHEN prev IS NULL OR i - prev > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS part FROM o),
        r AS (SELECT doc_id, part, min(i) AS a, max(i) + 50 AS b FROM p GROUP BY doc_id, part),
        k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM r),
        t AS (SELECT k.doc_id, string_agg(substr(x, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS head,
                     max(b) AS last, sum(b - a) AS removed, count(*) AS spans FROM k JOIN n ON k.doc_id = n.doc_id GROUP BY k.doc_id)
        SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_bytes, CAST(coalesce(t.removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(t.spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(coalesce(t.head, '') || substr(x, 2 * coalesce(t.last, 0) + 1))) AS kept_sha256
        FROM n LEFT JOIN t ON n.doc_id = t.doc_id""",
    "op11_hard_negatives": """
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
              FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
}
