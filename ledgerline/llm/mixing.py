"""Mixing sources to target weights (1): a multivariate-hypergeometric splitting tree.

The words of a source, documents laid end to end in hash order, are cut into
blocks of ``block_words`` words. A target of T words out of S is T div S whole
passes over the blocks and, of one more pass, the first blocks of a fresh
permutation until T is reached; the last of these is cut. So every source has
an exact quota of blocks. The tree hands the quotas to the output shards: a
node halves its number of blocks and draws, source by source, how many of
each go left (hypergeometric, by inversion from the mode outwards), which is
the law of dealing the shuffled blocks of all sources to the shards. A shard
then takes the next of each source's permuted blocks, so shards are disjoint;
``place`` orders a shard's pieces at random.

Only DataFrame and SQL functions are used. Randomness comes from hashes of
ids, so a rerun gives the same mix. Positions and permutation ranks are
computed per hash bucket plus an offset from bucket totals: no task holds a
whole source.

Defined cases: a null or blank text has size 0 and nothing of it is taken; a
null source is a source of its own, ordered last; rows repeated whole are
separate rows; a null doc_id is an id of its own; an empty table gives an
empty mix; sources without words get target 0. A document that lies across
the edge of a drawn block is taken in part; with ``whole`` (the pipeline's mix) blocks end at document
edges instead, every document is taken whole or not, and a source's words are off its target by half a
document at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.llm.common import NULL_ID, free_names, give_back_ids, hex_digits, keep_table, running_before

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 4096
SHARD_WORDS = 1 << 24
MIN_SHARDS = 8
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 7


def sized_rows(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, key (source), size in words, and ``h``, ``copy``,
    which with doc_id name a row even when rows repeat."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                    F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")).alias("key"),
                    F.xxhash64(text, F.coalesce(F.col("source"), F.lit(""))).alias("h"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    return d.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "h").orderBy("key", "size")))


def source_targets(sized: DataFrame) -> DataFrame:
    """Per source: sid (from 0, by code point, null last), source_size, target, and the
    numbers of blocks that follow from it.

    A target is weight * level, stopped at ``MAX_REPEATS`` times the source's size;
    the level is where the targets add up to all words (what resharing the excess
    by weight ends at). One row per source; the windows here run over that table."""
    s = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    all_sources = Window.orderBy(F.col("key") == F.lit("n"), "key")
    w = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), (F.col("sid") % len(WEIGHTS) + 1).cast("int")).cast("long")
    s = (s.withColumn("sid", (F.row_number().over(all_sources) - 1).cast("long"))
         .withColumn("w", w).withColumn("cap", F.col("source_size") * MAX_REPEATS))
    by_cap = Window.orderBy((F.col("cap") / F.col("w")), "sid")
    s = (s.withColumn("capped_before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("w_from", F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("total", F.sum("source_size").over(Window.partitionBy())))
    s = s.withColumn("capped", F.col("cap") * F.col("w_from") <= F.col("w") * (F.col("total") - F.col("capped_before")))
    every = Window.partitionBy()
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    free = F.coalesce(F.sum(F.when(~F.col("capped"), F.col("w"))).over(every), F.lit(1))
    s = s.withColumn("rest", rest).withColumn("free", free)
    return s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double"))
                        .otherwise((F.col("w") * F.col("rest")).cast("double") / F.col("free"))) \
            .select("key", "sid", "source_size", "target")


def _quotas(targets: DataFrame, block: int) -> DataFrame:
    size, take = F.col("source_size"), F.col("take")
    t = (targets.withColumn("take", F.floor(F.col("target") + 0.5).cast("long"))
         .withColumn("n_blocks", F.ceil(size / F.lit(block)).cast("long"))
         .withColumn("passes", F.when(size > 0, F.floor(take / size)).otherwise(0).cast("long")))
    t = t.withColumn("rest_words", take - F.col("passes") * size)
    # blocks of the last pass, by the words before each rank; one block is short
    return t.withColumn("short_by", F.col("n_blocks") * block - size)


def hypergeometric(total: str, good: str, draws: str, u: str) -> str:
    """SQL for the number of ``good`` among ``draws`` of ``total`` at the uniform
    number ``u``: weights relative to the mode's, by the ratio of neighbours, summed
    up to 12 standard deviations out, then inverted in the order mode, up, down."""
    let = ("transform(array(named_struct('all_n', double({N}), 'good_n', double({K}), 'draws_n', double({n}), 'u', {u})), v -> "
           "transform(array(named_struct('lo', bigint(greatest(0D, v.draws_n + v.good_n - v.all_n)), 'hi', bigint(least(v.draws_n, v.good_n)), "
           "'mode', bigint(floor((v.draws_n + 1) * (v.good_n + 1) / (v.all_n + 2))), "
           "'reach', bigint(ceil(12 * sqrt(v.draws_n * (v.good_n / greatest(v.all_n, 1D)) * (1 - v.good_n / greatest(v.all_n, 1D)) * (v.all_n - v.draws_n) / greatest(v.all_n - 1, 1D)))) + 10)), r -> "
           "transform(array(named_struct('m', greatest(r.lo, least(r.hi, r.mode)))), c -> "
           "transform(array(named_struct('top', least(r.hi, c.m + r.reach), 'low', greatest(r.lo, c.m - r.reach))), e -> "
           "transform(array(named_struct("
           "'up', aggregate(sequence(c.m, e.top), named_struct('w', 1D, 's', 0D), (a, k) -> named_struct('w', {up}, 's', a.s + a.w), a -> a.s), "
           "'down', if(c.m > e.low, aggregate(sequence(c.m, e.low + 1, -1L), named_struct('w', 1D, 's', 0D), "
           "(a, k) -> named_struct('w', {down}, 's', a.s + {down}), a -> a.s), 0D))), z -> "
           "transform(array(aggregate(sequence(c.m, e.top), named_struct('w', 1D, 't', v.u * (z.up + z.down), 'x', -1L), "
           "(a, k) -> named_struct('w', {up}, 't', if(a.x < 0, a.t - a.w, a.t), 'x', if(a.x < 0 and a.t < a.w, k, a.x)))), p -> "
           "if(p.x >= 0 or c.m = e.low, if(p.x >= 0, p.x, c.m), "
           "aggregate(sequence(c.m, e.low + 1, -1L), named_struct('w', 1D, 't', p.t, 'x', -1L), "
           "(a, k) -> named_struct('w', {down}, 't', if(a.x < 0, a.t - {down}, a.t), 'x', if(a.x < 0 and a.t < {down}, k - 1, a.x)), "
           "a -> if(a.x < 0, e.low, a.x))))[0])[0])[0])[0])[0])[0]")
    up = "a.w * (v.good_n - k) * (v.draws_n - k) / ((k + 1D) * (v.all_n - v.good_n - v.draws_n + k + 1D))"
    down = "a.w * k * (v.all_n - v.good_n - v.draws_n + k) / ((v.good_n - k + 1D) * (v.draws_n - k + 1D))"
    return let.format(N=total, K=good, n=draws, u=u, up=up, down=down)


def split_quotas(quotas: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """(sid, n) of the whole mix -> (shard, sid, n) of 2**levels shards.

    A node is one row with the list of its sources that have blocks left; the
    root lists all sources, a leaf at most as many as it has blocks."""
    nodes = quotas.where("n > 0").agg(F.sort_array(F.collect_list(F.struct("sid", "n"))).alias("q"),
                                      F.sum("n").alias("total")).where("total > 0").withColumn("node", F.lit(1).cast("long"))
    u = f"(xxhash64({seed}, node, s.sid) & 9007199254740991L) / 9007199254740992D"
    draw = (f"aggregate(q, named_struct('rest', total, 'room', total div 2, 'l', cast(array() as array<bigint>)), (a, s) -> "
            f"transform(array({hypergeometric('a.rest', 's.n', 'a.room', u)}), x -> "
            f"named_struct('rest', a.rest - s.n, 'room', a.room - x, 'l', array_append(a.l, x)))[0], a -> a.l)")
    for _ in range(levels):
        nodes = nodes.withColumn("l", F.expr(draw)).select(F.explode(F.expr(
            "array(named_struct('node', node * 2, 'total', total div 2, 'q', filter(zip_with(q, l, (s, x) -> named_struct('sid', s.sid, 'n', x)), s -> s.n > 0)), "
            "named_struct('node', node * 2 + 1, 'total', total - total div 2, 'q', filter(zip_with(q, l, (s, x) -> named_struct('sid', s.sid, 'n', s.n - x)), s -> s.n > 0)))")).alias("c")) \
            .select("c.*")
    return nodes.select((F.col("node") - (1 << levels)).alias("shard"), F.explode("q").alias("s")).select("shard", "s.sid", "s.n")


def _word_blocks(laid: DataFrame, targets: DataFrame, words: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of ``block_words`` words: the parts of documents in them, and the drawn blocks (sid, pass, block, words, turn)."""
    lo_block, hi_block = F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words)
    parts = (laid.where("size > 0").select("doc_id", "h", "copy", "size", "sid", "at", F.explode(F.sequence(lo_block, hi_block)).alias("block"))
             .withColumn("from", F.greatest(F.col("at"), F.col("block") * block_words) - F.col("block") * block_words)
             .withColumn("to", F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words) - F.col("block") * block_words))

    # permutations: every pass of a source has its own; blocks come out in runs of 2**16 so that no task makes a whole source's
    runs = (targets.where("n_blocks > 0").select("sid", "n_blocks", "passes", "rest_words", "short_by",
                                                 F.explode(F.expr("sequence(0L, (n_blocks - 1) div 65536)")).alias("run"))
            .withColumn("pass", F.explode(F.expr("sequence(0L, passes)"))).where("pass < passes or rest_words > 0"))
    blocks = (runs.repartition("sid", "run", "pass")
              .withColumn("block", F.explode(F.expr("sequence(run * 65536, least(n_blocks, (run + 1) * 65536) - 1)")))
              .withColumn("hash", F.md5(F.concat_ws(":", "sid", "pass", "block"))).drop("run"))
    n_blocks = max(1, words // block_words)
    ranked = keep_table(running_before(blocks, ["sid", "pass"], ["block"], None, hex_digits(n_blocks), "rank"), "blocks")
    short = ranked.where("block = n_blocks - 1").select("sid", "pass", F.col("rank").alias("short_rank"))
    ranked = ranked.join(broadcast_if_small(short), ["sid", "pass"])
    full = F.least(F.lit(block_words).cast("long"), F.col("n_blocks") * block_words - F.col("short_by") - F.col("block") * block_words)
    before = F.col("rank") * block_words - F.when(F.col("rank") > F.col("short_rank"), F.col("short_by")).otherwise(0)
    drawn = (ranked.withColumn("words", F.when(F.col("pass") < F.col("passes"), full)
                               .otherwise(F.least(full, F.col("rest_words") - before)))
             .where("words > 0").withColumn("turn", F.col("pass") * F.col("n_blocks") + F.col("rank"))
             .select("sid", "pass", "block", "words", "turn"))
    return parts, drawn


def _whole_blocks(laid: DataFrame, targets: DataFrame, words: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    """The same with blocks of whole documents: a block has the documents whose middle lies in its ``block_words`` words, so it
    ends at the document edge nearest to theirs; ``from`` is the document's place in the block. The words
    of a drawn block are its own, of the last one of the last pass what is left to the target."""
    parts = laid.where("size > 0").withColumn("block", F.expr(f"(2 * at + size) div (2 * {block_words})"))
    own = keep_table(parts.groupBy("sid", "block").agg(F.min("at").alias("first"), F.sum("size").alias("own")), "own")
    parts = parts.join(own.select("sid", "block", "first"), ["sid", "block"]).withColumn("from", F.col("at") - F.col("first")) \
        .select("doc_id", "h", "copy", "size", "sid", "at", "block", "from")
    per = own.groupBy("sid").agg(F.count(F.lit(1)).alias("n_own"))
    per = broadcast_if_small(targets.select("sid", "passes", "rest_words").join(per, "sid"))
    blocks = (own.join(per, "sid").withColumn("pass", F.explode(F.expr("sequence(0L, passes)"))).where("pass < passes or rest_words > 0")
              .withColumn("hash", F.md5(F.concat_ws(":", "sid", "pass", "block"))))
    digits = hex_digits(max(1, words // block_words))
    ranked = running_before(blocks, ["sid", "pass"], ["block"], None, digits, "rank")
    ranked = keep_table(running_before(ranked, ["sid", "pass"], ["block"], "own", digits, "before"), "blocks")
    drawn = (ranked.withColumn("words", F.when(F.col("pass") < F.col("passes"), F.col("own"))
                               .otherwise(F.least("own", F.col("rest_words") - F.col("before"))))
             .where("words > 0").withColumn("turn", F.col("pass") * F.col("n_own") + F.col("rank"))
             .select("sid", "pass", "block", "words", "turn"))
    return parts, drawn


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        seed: int = SEED, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces). ``rows``: every document row with size, source_size, target.
    ``pieces``: doc_id, h, copy, size, shard, pass, block, lo, hi, place: the words
    [lo, hi) of that row belong to the shard, in the order of ``place``. With ``whole`` that is always [0, size)."""
    sized = keep_table(sized_rows(docs), "sizes")
    targets = keep_table(_quotas(source_targets(sized), block_words), "targets")
    n_rows, words = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = max(MIN_SHARDS, 1 << max(0, -(-int(words) // shard_words) - 1).bit_length())
    rows = sized.join(broadcast_if_small(targets.select("key", "sid", "source_size", "target")), "key")

    laid = running_before(rows.withColumn("hash", F.md5(F.col("doc_id").cast("string"))), ["sid"], ["doc_id", "h", "copy"],
                   "size", hex_digits(n_rows), "at")
    parts, drawn = (_whole_blocks if whole else _word_blocks)(laid, targets, int(words), block_words)

    quotas = drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    leaves = keep_table(split_quotas(quotas, shards.bit_length() - 1, seed), "leaves")
    first = F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = leaves.withColumn("first", first).select("sid", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("turn"))
    dealt = drawn.join(turns, ["sid", "turn"]).drop("turn")

    pieces = parts.join(dealt, ["sid", "block"])
    if whole:                                             # in or out by the document's middle
        pieces = pieces.where("2 * from + size <= 2 * words").withColumn("lo", F.lit(0).cast("long")).withColumn("hi", F.col("size"))
    else:
        pieces = (pieces.withColumn("to", F.least("to", "words")).where("to > from")
                  .withColumn("lo", F.col("block") * block_words + F.col("from") - F.col("at"))
                  .withColumn("hi", F.col("block") * block_words + F.col("to") - F.col("at")))
    pieces = (pieces.select("doc_id", "h", "copy", "size", "shard", "pass", "block", "lo", "hi")
              .withColumn("place", F.xxhash64(F.lit(seed), "shard", "pass", "block", "doc_id", "h", "copy")))
    return rows, pieces


def taken_words(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken, shards (that hold some of it)."""
    rows, pieces = mix(docs, block_words)
    got = pieces.groupBy("doc_id", "h", "copy").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"),
                                                    F.count_distinct("shard").alias("shards"))
    out = rows.join(got, ["doc_id", "h", "copy"], "left")
    return give_back_ids(out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
                                    F.coalesce("shards", F.lit(0).cast("long")).alias("shards")))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: one row, as it is in ``docs``, per document and pass that takes it. No document is cut."""
    _, pieces = mix(docs, block_words, whole=True)
    own, row, copy = free_names(docs, "_id", "_h", "_copy")
    taken = pieces.select(F.col("doc_id").alias(own), F.col("h").alias(row), F.col("copy").alias(copy))
    text = F.coalesce(F.col("text"), F.lit(""))
    d = (docs.withColumn(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
         .withColumn(row, F.xxhash64(text, F.coalesce(F.col("source"), F.lit("")))))
    d = d.withColumn(copy, F.row_number().over(Window.partitionBy(own, row).orderBy(F.lit(0))))
    return d.join(taken, [own, row, copy]).select(*docs.columns)
