"""Mixing sources to target weights by weighted fair queueing.

Every document of a source gets a place in a shuffled order of that source; a copy's virtual finish time is
the number of source words up to its end, earlier passes over the source included, divided by the source's
target. All copies are ranged by finish time and the mix is what fits into the total budget.

Neither a source nor the whole order ever meets in one task. A source's running sum is split over ``SLICES``
equal ranges of the shuffled order, with the sums of the earlier ranges added; the global order is cut into
ranges of finish time, and only the range that the budget ends in is sorted row by row. What is gathered is
one row per source and range, and on the driver the last row of the mix.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machpulse.llm.text import words
from machpulse.sources.storage import stored

SLICE_BITS = 12
SLICES = 1 << SLICE_BITS
TIME_RANGES = 4096


def _shares(sources: DataFrame, weights: tuple[int, ...], passes: int) -> DataFrame:
    """One row per source with its target: shares by weight, stopped at ``passes`` times the source's size.

    A source is stopped before another if its limit is lower for its weight. With the first k stopped, the rest
    share what is left by weight; the right k is the first that stops nobody else. The windows run over sources.
    """
    by_name, by_limit = Window.orderBy("_key"), Window.orderBy("_ratio", "_key")
    everything = Window.partitionBy()
    place = (F.row_number().over(by_name) - 1) % F.lit(len(weights))
    weighed = sources.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double"))
    limit = F.col("_source_size") * F.lit(float(passes))
    ordered = weighed.withColumn("_limit", limit).withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_source_size").over(everything)
    level = (total - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / (
        F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    levels = ordered.withColumn("_level", level).withColumn("_total", total)
    settled = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_key", "_level"))).over(everything)
    final = F.coalesce(settled["_level"], F.lit(float("inf")))
    return levels.select("_key", "_source_size", "_total", F.least("_limit", final * F.col("_weight")).alias("_target"))


def _finish(turn: int) -> Column:
    """Virtual finish time of the copy of pass ``turn``; null for documents that cannot be taken."""
    return F.when(
        (F.col("_size") > 0) & (F.col("_target") > 0),
        (F.col("_end") + F.lit(turn) * F.col("_source_size")) / F.col("_target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    passes: int = 3,
    seed: int = 7,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id_col, size, source_size, target, copies, taken, source``.

    Sources, by code point with null last, weigh ``weights`` in turn and share the words of all documents.
    ``taken`` is ``copies * size``, with at most ``passes`` copies. Documents without words (null, empty) have
    size 0 and are not taken; a source without words has target 0. Repeated rows are separate documents.
    Equal input gives equal output, whatever the partitions. Columns named in ``carry`` (of types that have an order) are
    handed on, others are ignored; an empty table gives none.
    """
    key = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    sized = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        key.alias("_key"),
        F.size(words(text_col)).cast("long").alias("_size"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
    )
    order = F.xxhash64(F.lit(seed), "_key", "_id", "_size")
    sized = stored(sized.withColumn("_order", order).withColumn("_slice", F.shiftrightunsigned("_order", 64 - SLICE_BITS)), "mix-sizes")

    slices = sized.groupBy("_key", "_slice").agg(F.sum("_size").alias("_sum"))
    shares = _shares(slices.groupBy("_key").agg(F.sum("_sum").alias("_source_size")), weights, passes)
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.join(shares, "_key").select(
        "_key", "_slice", "_source_size", "_target", "_total",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
    )
    # Rows alike in id and size are told apart by what they carry; then nothing tells them apart.
    carried = [f"_c{i}" for i in range(len(carry))]
    within = Window.partitionBy("_key", "_slice").orderBy("_order", "_id", "_size", *carried).rowsBetween(Window.unboundedPreceding, 0)
    placed = stored(
        sized.join(starts, ["_key", "_slice"]).withColumn("_end", F.col("_start") + F.sum("_size").over(within)), "mix-places"
    )

    copies = placed.select(
        "_id", "_key", "_order", "_size", "_total", F.explode(F.array(*[_finish(turn) for turn in range(passes)])).alias("_time")
    ).filter(F.col("_time").isNotNull())
    ranged = copies.withColumn("_range", F.least(F.floor(F.col("_time") * TIME_RANGES), F.lit(4 * TIME_RANGES)))
    until = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    sums = ranged.groupBy("_range").agg(F.sum("_size").alias("_sum"), F.max("_total").alias("_total"))
    sums = sums.withColumn("_until", F.sum("_sum").over(until))
    first_over = sums.filter(F.col("_until") > F.col("_total")).orderBy("_range").select(
        "_range", (F.col("_until") - F.col("_sum")).alias("_before")
    ).first()
    last = None
    if first_over is not None:
        running = Window.orderBy("_time", "_key", "_order", "_id").rowsBetween(Window.unboundedPreceding, 0)
        crossing = ranged.filter(F.col("_range") == F.lit(first_over["_range"]))
        fits = crossing.withColumn("_run", F.sum("_size").over(running) + F.lit(first_over["_before"])).filter(
            F.col("_run") <= F.col("_total")
        )
        last = fits.agg(F.max(F.struct("_time", "_key", "_order", "_id")).alias("last")).first()["last"]

    def taken(turn: int) -> Column:
        time = _finish(turn)
        here = F.least(F.floor(time * TIME_RANGES), F.lit(4 * TIME_RANGES))
        if first_over is None:
            yes = time.isNotNull()
        else:
            yes = time.isNotNull() & (here < F.lit(first_over["_range"]))
            if last is not None:
                mine = F.struct(time.alias("_time"), F.col("_key"), F.col("_order"), F.col("_id"))
                kind = placed.select(mine.alias("m")).schema["m"].dataType.simpleString()
                bound = F.struct(F.lit(last["_time"]).alias("_time"), F.lit(last["_key"]).alias("_key"), F.lit(last["_order"]).alias("_order"), F.lit(last["_id"]).alias("_id"))
                yes = yes | (time.isNotNull() & (here == F.lit(first_over["_range"])) & (mine <= bound.cast(kind)))
        return F.coalesce(yes.cast("long"), F.lit(0))

    count = sum((taken(turn) for turn in range(1, passes)), taken(0))
    return placed.withColumn("_copies", count).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
        F.col("_copies").alias("copies"),
        F.col("_source").alias("source"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
    )
