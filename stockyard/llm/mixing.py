"""Mixing of sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the tokens of its source up to and with it, in shuffled
order, divided by the source's target. All documents are put in the order of these times, over all
sources, and the mix is cut where the total budget is used up. A source whose target is above its size
is queued again, up to ``max_epochs`` times.

Defined results: NULL sources are one source, after all others; a NULL or negative size counts as 0; an
empty table gives an empty mix; equal finish times are taken all or none; repeated rows are documents of
their own. Columns of the input are not touched, whatever their names.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockyard.llm.rows import ROW, numbered, unused
from stockyard.operators.keys import assign_surrogate_keys
from stockyard.sources.shared_dir import cut_lineage

#: A slice of the order with so few rows is summed exactly instead of being divided further.
_FINE = 50_000


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Target of each source: its weight's share of all tokens, at most ``max_epochs`` times its size.

    ``sizes`` has ``source, source_size``, a row per source. Weights repeat over the sources by code
    point, NULL last. What a source cannot give is shared by weight among those below their limit, until
    no target is above its limit. Only sums reach the driver.
    """
    ordered = sizes.select(F.col("source").isNull().alias("__last"), "source", F.col("source_size").cast("long").alias("source_size"))
    ranked = assign_surrogate_keys(ordered, "__rank", ["__last", "source"])
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = cut_lineage(ranked.select(
        "source", "source_size", (F.lit(max_epochs) * F.col("source_size")).cast("double").alias("__limit"),
        F.element_at(cycle, ((F.col("__rank") - 1) % len(weights) + 1).cast("int")).alias("weight")))
    level, full = 0.0, -1
    while True:
        free = F.col("__limit") > F.lit(level) * F.col("weight")
        total, given, left, held = ranked.agg(
            F.sum("source_size"), F.sum(F.when(~free, F.col("__limit"))), F.sum(F.when(free, F.col("weight"))), F.count_if(~free)).first()
        if not total or held == full or not left:
            break
        full, level = held, (total - (given or 0.0)) / left
    return ranked.select("source", "source_size", "weight", F.least("__limit", F.lit(level) * F.col("weight")).alias("target"))


def _bits(rows: int) -> int:
    """Buckets as a power of two, about the square root of the rows: neither a bucket nor the list of buckets grows large."""
    return max(1, math.ceil(math.log2(max(rows, 2)) / 2))


def _finish_times(queue: DataFrame, targets: DataFrame, rows: int) -> DataFrame:
    """``queue`` (row, source, size, place in the shuffle) with the tokens of its source up to each row."""
    bits = _bits(rows)
    cut = queue.withColumn("__bucket", F.shiftrightunsigned("__place", 64 - bits))
    sums = cut.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__all"))
    upto = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sums.select(F.col("__source").alias("__s"), F.col("__bucket").alias("__b"), (F.sum("__all").over(upto) - F.col("__all")).alias("__start"))
    inside = Window.partitionBy("__source", "__bucket").orderBy("__place", ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (cut.withColumn("__in", F.sum("__size").over(inside))
            .join(starts, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")), "left")
            .withColumn("__upto", F.col("__in") + F.col("__start")).drop("__s", "__b", "__start", "__in", "__bucket")
            .join(targets.select(F.col("source").alias("__s"), "source_size", "target"), F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s"))


def _time(epoch) -> F.Column:
    return F.when(F.col("target") > 0, (F.col("__upto") + epoch * F.col("source_size")) / F.col("target"))


def _last_time(times: DataFrame, budget: int, rows: int) -> float:
    """The greatest finish time up to which all documents together stay within the budget.

    The range of times is divided into equal slices, the slice that crosses the budget again, until it is small.
    """
    low, base = -1.0, 0
    high, all_tokens = times.agg(F.max("__time"), F.sum("__size")).first()
    if high is None or all_tokens <= budget:
        return high if high is not None else low
    slices = 4 << _bits(rows)
    upto = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        here = times.where((F.col("__time") > low) & (F.col("__time") <= high))
        width = (high - low) / slices
        place = F.least(F.floor((F.col("__time") - low) / width), F.lit(slices - 1))
        step = here.groupBy(place.alias("__slice")).agg(F.sum("__size").alias("__all"), F.count("*").alias("__rows"), F.min("__time").alias("__from"), F.max("__time").alias("__to"))
        step = step.withColumn("__upto", F.sum("__all").over(upto))
        crossed = step.where(F.col("__upto") + base > budget).orderBy("__slice").first()
        if crossed is None:
            return high
        before = step.where(F.col("__upto") + base <= budget).agg(F.max("__to")).first()[0]
        base, start = base + crossed["__upto"] - crossed["__all"], low if before is None else before
        if crossed["__from"] == crossed["__to"]:
            return start
        if crossed["__rows"] <= _FINE:
            single = times.where((F.col("__time") >= crossed["__from"]) & (F.col("__time") <= crossed["__to"])).groupBy("__time").agg(F.sum("__size").alias("__all"))
            rising = Window.orderBy("__time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            fits = single.withColumn("__upto", F.sum("__all").over(rising)).where(F.col("__upto") + base <= budget).agg(F.max("__time")).first()[0]
            return start if fits is None else fits
        low, high = start, crossed["__to"]


def _queued(docs: DataFrame, source, size, order, weights, max_epochs: int, seed: int, keep) -> tuple[DataFrame, float]:
    """A row per document with what its finish times follow from, and the last time within the budget."""
    queue = cut_lineage(numbered(docs).select(
        ROW, source.alias("__source"), F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("__size"),
        F.xxhash64(F.lit(seed), order).alias("__place"), *keep))
    rows = queue.count()
    targets = source_targets(queue.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size")), weights, max_epochs)
    timed = cut_lineage(_finish_times(queue, targets, rows))
    budget = queue.agg(F.sum("__size")).first()[0] or 0
    times = (timed.where(F.col("__size") > 0).select("__size", F.explode(F.array(*[_time(e) for e in range(max_epochs)])).alias("__time")).where(F.col("__time").isNotNull()))
    return timed, _last_time(times, budget, rows)


def mix_rows(docs: DataFrame, source, size, order, weights=(1, 2, 3), max_epochs: int = 3, seed: int = 1, keep=()) -> DataFrame:
    """One narrow row per document of ``docs``: its number, source, size, target and how often the mix takes it.

    ``source``, ``size`` and ``order`` are columns; ``order`` (an id) with ``seed`` decides a document's place
    in the shuffle. ``keep`` are further columns to carry. Texts are read once and not shuffled; the queue, a few numbers a row,
    is written to the shared folder. The rows are in no order.
    """
    timed, last = _queued(docs, source, size, order, weights, max_epochs, seed, keep)
    copies = sum((F.when(_time(e) <= last, 1).otherwise(0) for e in range(max_epochs)), F.lit(0))
    carried = timed.columns[timed.columns.index("__place") + 1:timed.columns.index("__upto")]
    return timed.select(ROW, F.col("__source").alias("source"), F.col("__size").alias("size"), "source_size", "target", copies.alias("copies"),
                        (copies * F.col("__size")).cast("long").alias("taken"), *carried)


def mix(docs: DataFrame, source, size, order, weights=(1, 2, 3), max_epochs: int = 3, seed: int = 1) -> DataFrame:
    """``docs`` as mixed: every document as often as the mix takes it, all columns as they were, by finish time.

    Partitions are ranges of the finish times, in order, and sorted inside; equal times go by row number.
    """
    timed, last = _queued(docs, source, size, order, weights, max_epochs, seed, ())
    turns = F.filter(F.array(*[F.struct(_time(e).alias("time"), F.lit(e).alias("epoch")) for e in range(max_epochs)]), lambda t: t["time"] <= last)
    row = unused(docs.columns, ROW)
    of, all_turns, turn = f"{row}_of", f"{row}_turns", f"{row}_turn"
    taken = timed.select(F.col(ROW).alias(of), turns.alias(all_turns)).where(F.size(all_turns) > 0)
    place = [F.col(f"{turn}.time"), F.col(row), F.col(f"{turn}.epoch")]
    repeated = numbered(docs, row).join(taken, F.col(row) == F.col(of)).withColumn(turn, F.explode(all_turns))
    return repeated.repartitionByRange(*place).sortWithinPartitions(*place).select(*[F.col(f"`{c}`") for c in docs.columns])
