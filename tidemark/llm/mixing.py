"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be copied ``target / source_size`` times. The
whole part is certain; the fraction is a copy probability. Documents are dealt
into blocks of about ``block`` per source. Within a block, two fractional
documents at a time exchange probability mass, weighted by their words so that
the expected words stay the same, in a random direction drawn by the keyed odds
that keep each document's own probability, until one of them is 0 or 1. Each
block ends with at most one fractional document; those residuals meet in blocks
of the next level, and so on up a reduction tree whose fan-in is ``block``. The
words taken from a source therefore miss its target by less than one document.

Rows of one source, id and size are alike: they are counted first and numbered
from the count, so that any number of them is dealt over all blocks and reruns
agree on how many of them are taken.

Everything is DataFrame functions; the exchange runs in the higher-order
function ``aggregate`` over a block's array. Targets are computed in one task, on
one row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import keep, words_in

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST_COPIES = 3
#: Rows alike that one task numbers.
ALIKE = 10_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target from rows of source, size and how many rows are alike (n).

    The targets are shares of the total size by weight, held at ``most`` times
    the source's size; what is held back is shared again by weight. With sources
    in order of cap over weight the held ones come first, so running sums find
    them without iterating. It works on one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    per = per.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double"))
    per = per.withColumn("_cap", F.col("source_size").cast("double") * most)
    everything = Window.partitionBy(F.lit(1))
    before = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    left = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    per = per.withColumn("_held", F.col("_cap") * left <= rest * F.col("_w"))
    free = F.sum(F.col("source_size").cast("double")).over(everything) - F.sum(F.when(F.col("_held"), F.col("_cap")).otherwise(0.0)).over(everything)
    level = F.try_divide(free, F.sum(F.when(F.col("_held"), 0.0).otherwise(F.col("_w"))).over(everything))
    return per.withColumn("target", F.when(F.col("_held"), F.col("_cap")).otherwise(F.coalesce(level * F.col("_w"), F.lit(0.0)))).select("source", "source_size", "target")


def _exchange(seed: int) -> str:
    """SQL that folds an array of (h, id, size, p) into (h, id, size, p, done)."""
    state = "named_struct('h', {0}.h, 'id', {0}.id, 'size', {0}.size, 'p', {1}, 'done', {2})"
    done = "concat(s.done, array(named_struct('id', {0}.id, 'size', {0}.size, 'up', {1})))"
    s_up = state.format("x", "x.p - v.raise * s.size / x.size", done.format("s", "true"))
    x_down = state.format("s", "s.p + v.raise", done.format("x", "false"))
    s_down = state.format("x", "x.p + v.lower * s.size / x.size", done.format("s", "false"))
    x_up = state.format("s", "s.p - v.lower", done.format("x", "true"))
    return f"""
    aggregate(_units,
      named_struct('h', cast(null as bigint), 'id', cast(null as bigint), 'size', cast(0 as double), 'p', cast(-1 as double),
                   'done', cast(array() as array<struct<id: bigint, size: double, up: boolean>>)),
      (s, x) -> if(s.size = 0, {state.format("x", "x.p", "s.done")},
        transform(array(named_struct(
            'raise', least(1 - s.p, x.p * x.size / s.size),
            'lower', least(s.p, (1 - x.p) * x.size / s.size),
            'u', (xxhash64({seed}L, s.h, x.h) & 4503599627370495) / 4503599627370496D)), v ->
          if(v.u * (v.raise + v.lower) < v.lower,
             if(1 - s.p <= x.p * x.size / s.size, {s_up}, {x_down}),
             if(s.p <= (1 - x.p) * x.size / s.size, {s_down}, {x_up})))[0]))"""


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, block: int = 256, seed: int = 20_240_601) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    ``taken`` is the document's words times its copies. Draws depend on the seed,
    the ids and the sizes only, so reruns agree. Defined cases: a null text has size 0; the
    null source is a source of its own, last in order; documents of size 0 and
    sources without words take 0; repeated rows are units of their own; an empty
    table gives no rows; other columns of the input are ignored.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in(F.col("text")).alias("size"))
    sized = keep(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")))
    targets = source_targets(sized, weights, most)
    counts = sized.filter("size > 0").groupBy("source").agg(F.sum("n").alias("_units")).withColumnRenamed("source", "_s")
    per = targets.join(counts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)).alias("_f"), F.greatest(F.lit(1), F.ceil(F.coalesce("_units", F.lit(0)) / block)).cast("long").alias("_blocks")
    )
    per = keep(per)
    most_blocks, alike = per.agg(F.max("_blocks")).first()[0] or 1, sized.agg(F.max("n")).first()[0] or 0
    numbered = sized.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / ALIKE))))
    if alike > ALIKE:
        numbered = numbered.repartition("doc_id", "source", "size", "_part")
    first = F.col("_part") * ALIKE
    numbered = numbered.withColumn("_k", F.explode(F.sequence(first, F.least(first + ALIKE, F.col("n")) - 1))).drop("n", "_part")
    # a source can hold most rows: its one row is repeated over salts, and documents are spread over them
    salts = 64
    spread = per.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = numbered.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "size", "_k"), F.lit(salts)).cast("int"))
    on = salted["source"].eqNullSafe(spread["_source"]) & (salted["_salt"] == spread["_salt"])
    units = salted.join(spread, on).drop(spread["_salt"]).drop("source", "_salt")
    units = units.withColumn("_whole", F.floor("_f")).withColumn("_p", F.col("_f") - F.floor("_f"))
    fractional = (F.col("_p") > 0) & (F.col("size") > 0)
    certain = units.filter(~fractional).select("doc_id", "size", "source_size", "target", (F.col("_whole") * F.col("size")).alias("taken"))

    same = ["_source", "source_size", "target", "_whole"]
    level = units.filter(fractional).select(
        *same,
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "_k"), F.col("_blocks")).alias("_block"),
        F.struct(F.xxhash64(F.lit(seed + 1), "doc_id", "size", "_k").alias("h"), F.col("doc_id").alias("id"), F.col("size").cast("double").alias("size"), F.col("_p").alias("p")).alias("_unit"),
    )
    out, depth = [certain], max(1, math.ceil(math.log(max(2, most_blocks), block))) + (most_blocks > 1)
    for k in range(depth):
        folded = level.groupBy(*same, "_block").agg(F.sort_array(F.collect_list("_unit")).alias("_units"))
        folded = keep(folded.withColumn("_r", F.expr(_exchange(seed + 2 + k))).drop("_units"))
        decided = F.col("_r.done")
        if k == depth - 1:
            last = F.struct(F.col("_r.id").alias("id"), F.col("_r.size").alias("size"), (F.expr(f"(xxhash64({seed - 1}L, _r.h, _source) & 4503599627370495) / 4503599627370496D") < F.col("_r.p")).alias("up"))
            decided = F.concat(decided, F.array(last))
        done = folded.select(*same, F.explode(decided).alias("_d"))
        out.append(done.select(F.col("_d.id").alias("doc_id"), F.col("_d.size").cast("long").alias("size"), "source_size", "target", ((F.col("_whole") + F.col("_d.up").cast("long")) * F.col("_d.size").cast("long")).alias("taken")))
        level = folded.select(*same, F.floor(F.col("_block") / block).alias("_block"), F.struct(F.col("_r.h").alias("h"), F.col("_r.id").alias("id"), F.col("_r.size").alias("size"), F.col("_r.p").alias("p")).alias("_unit"))
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", F.col("taken").cast("long").alias("taken"))
