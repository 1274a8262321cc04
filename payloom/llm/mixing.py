"""Mixing sources to token targets by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm.common import WORD, written

BUCKETS = 256
KEY = ["has_source", "source_name"]
NEWTON_STEPS = 100


def _ranked(sources: DataFrame) -> DataFrame:
    """Rank of each source by code point, null last, without bringing all of them into one task."""
    parts = written(sources.withColumn("no_source", ~F.col("has_source")).repartitionByRange("no_source", "source_name")
                    .withColumn("part", F.spark_partition_id()), "mix-sources")
    before = parts.groupBy("part").count().select("part", F.coalesce(
        F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("no_source", "source_name"))
    return parts.withColumn("within", within).join(before, "part").select(
        *sources.columns, (F.col("before") + F.col("within") - 1).alias("rank"))


def _targets(sources: DataFrame, share: float, weights: tuple[float, ...], most: float) -> DataFrame:
    """Targets: shares by weight that stop at `most` times a source's size, the excess shared among the others.

    The level (words per weight) only rises; each round is one aggregate over the sources.
    """
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = written(sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")), "mix-weights")
    budget = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        capped = F.col("cap") <= F.lit(level) * F.col("weight")
        got = rows.agg(F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
                       F.count(F.when(capped, 1))).first()
        if got[2] == full:
            break
        full = got[2]
        if got[1] <= 0:
            level = float("inf")
            break
        level = (budget - got[0]) / got[1]
    return rows.withColumn("target", F.least(F.col("cap"), F.lit(level) * F.col("weight")))


def _rate(tilt: Column, size: Column, mean: Column, most: float) -> Column:
    """Documents' rates: 1, tilted by the exponential of the size, but at most `most`."""
    return F.exp(F.least(tilt * size / mean, F.lit(700.0))).cast("double")


def _solve(histogram: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """The tilt of each source, for which the expected words meet its target.

    Minimising the relative entropy to rates of 1 under a word constraint per
    source and 0 <= rate <= most gives rate = min(most, exp(tilt * size)). The
    dual is convex; its derivative, expected words less target, rises with the
    tilt. Newton steps on it run for all sources at once, each step one
    aggregate over the distributed counts of sizes; a step that leaves the
    bracket of the root is replaced by its middle.
    """
    least = F.col("least_size") / F.col("mean")
    ratio = F.col("target") / F.col("source_size")
    state = sources.withColumn("fixed", (F.col("target") >= F.col("cap")) | (F.col("target") <= 0)).select(
        *KEY, "target", "mean", "fixed", F.lit(0.0).alias("tilt"),
        F.when(ratio < 1, F.log(ratio) / least).otherwise(0.0).alias("low"), F.when(ratio > 1, F.log(F.lit(most)) / least).otherwise(0.0).alias("high"))
    free = written(state.filter(~F.col("fixed")), "mix-newton")
    for _ in range(NEWTON_STEPS):
        rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
        words = F.col("n") * F.col("size")
        open_rate = rate < most
        step = histogram.join(free, KEY).groupBy(*KEY).agg(
            F.sum(words * F.least(rate, F.lit(most))).alias("expected"),
            F.sum(F.when(open_rate, words * F.col("size") / F.col("mean") * rate).otherwise(0.0)).alias("slope"))
        # Words of one source sum to the target within a millionth: far below what rounding to copies leaves.
        free = free.join(step, KEY).withColumn("gap", F.col("expected") - F.col("target"))
        free = free.withColumn("low", F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("low")))
        free = free.withColumn("high", F.when(F.col("gap") >= 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - F.col("gap") / F.col("slope"))
        middle = (F.col("low") + F.col("high")) / 2
        done = (F.abs("gap") <= 1e-6 * F.col("target")) | (F.col("high") - F.col("low") <= 1e-12)
        moved = F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(middle)
        free = written(free.withColumn("moving", ~done).withColumn("tilt", F.when(done, F.col("tilt")).otherwise(moved))
                       .select(*KEY, "target", "mean", "fixed", "tilt", "low", "high", "moving"), "mix-newton")
        if not free.filter("moving").limit(1).count():
            break
    return state.filter("fixed").select(*KEY, "fixed", "tilt").unionByName(free.select(*KEY, "fixed", "tilt"))


def mix_sources(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", share: float = 1.5,
                weights: tuple[float, ...] = (3, 1, 2), most: float = 2.0) -> DataFrame:
    """How often the mix takes each document: (id, source, size, source_size, target, rate, copies, taken).

    size: words of the text (0 for null). Sources, in order of code points
    with null last, weigh `weights` in turn and share `share` times all
    words; no target exceeds `most` times its source's words, and what is
    above is shared again by weight. rate: the document's expected copies by
    entropy balancing; copies: whole copies, at most `most` (a whole number);
    taken = copies * size.

    Rounding: within a source, counts of sizes are rounded along the running
    sum of rates from the longest texts to the shortest, so a source misses its
    target by no more than its longest text; which documents of a size get the
    odd copies is settled by a hash of the id, in buckets, so that no source
    and no size is ever in one task. Reruns agree, except that rows with equal
    id, source and size may change places with each other.

    A null source is a source of its own. A source without words has target 0.
    Null ids, repeated rows and ties are rows like others. Empty tables give no
    rows. Other columns are not read.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").isNotNull().alias("has_source"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source_name"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = written(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))), "mix-sizes")
    cells = written(rows.groupBy(*KEY, "size", "bucket").agg(F.count("*").alias("n")), "mix-cells")
    histogram = written(cells.groupBy(*KEY, "size").agg(F.sum("n").alias("n")), "mix-histogram")
    sources = histogram.groupBy(*KEY).agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least_size"))
    sources = written(_targets(_ranked(sources), share, weights, most), "mix-targets")
    tilts = written(_solve(histogram, sources, most), "mix-tilts")

    solved = sources.join(tilts, KEY)
    # Nine decimals: sums in another order end in the same rates, so reruns round alike.
    free_rate = F.round(F.least(_rate(F.col("tilt"), F.col("size"), F.col("mean"), most), F.lit(most)), 9)
    rated = histogram.join(solved, KEY).withColumn("rate", F.when(F.col("target") <= 0, 0.0).when(F.col("fixed"), most).otherwise(free_rate))
    by_size = Window.partitionBy(*KEY).orderBy(F.desc("size"))
    upto = F.floor(F.sum(F.col("n") * F.col("rate")).over(by_size) + 0.5)
    rounded = rated.withColumn("upto", upto).withColumn("quota", F.col("upto") - F.coalesce(F.lag("upto").over(by_size), F.lit(0)))
    sizes = rounded.select(*KEY, "size", F.col("n").alias("of"), "rate", "quota", "source_size", "target")

    cell = [*KEY, "size", "bucket"]
    in_size = Window.partitionBy(*KEY, "size").orderBy("bucket")
    dealt = cells.join(sizes, [*KEY, "size"]).withColumn("seen", F.sum("n").over(in_size))
    dealt = dealt.withColumn("upto", F.floor(F.col("seen") * F.col("quota") / F.col("of") + 0.5))
    dealt = dealt.withColumn("own", F.col("upto") - F.coalesce(F.lag("upto").over(in_size), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    copies = F.floor(F.col("own") / F.col("n")) + F.when(F.col("place") <= F.col("own") % F.col("n"), 1).otherwise(0)
    return (rows.withColumn("place", place).join(dealt.select(*cell, "n", "own", "rate", "source_size", "target"), cell)
            .withColumn("copies", copies.cast("long"))
            .select(F.col("doc_id").alias(doc_id), F.when(F.col("has_source"), F.col("source_name")).alias(source), "size",
                    F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"), F.col("target").cast("double").alias("target"),
                    "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")))
