"""Shards of nearly equal bytes by Karmarkar-Karp differencing; copies of a text stay together.

A partial partition deals some groups over as many parts as are wanted. Differencing starts with one partial partition a group, all of it in
one part, and repeatedly combines the two with the largest spread between their fullest and emptiest parts, the fullest of
one with the emptiest of the other, until one is left. The groups of one task are dealt over ``WIDTH`` parts in this way (``FAN`` groups a
task in the mean, by hash); these parts are the groups of the next level, and the last level, a single task of at most ``FAN`` parts, deals
over the shards. Every level leaves a sixty-fourth of the rows of the one before. A group above a part's fair share is alone
in its part, so that later levels can still put small ones beside it. The rule is the same at every size.

Defined results: NULL and empty texts are equal and weigh one byte each, as every row weighs its bytes plus one; equal texts are one group however
many they are, so a group above a shard's fair share leaves the shards uneven, and then holds its shard alone; slots follow a hash of the row number, then
``doc_id`` (NULL last); repeated rows are copies; an empty table gives no rows; columns of the input are not touched, whatever their names.
The input must be a plain reading of files.
"""

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockyard.llm.rows import ROW, numbered, unused, whole
from stockyard.llm.scratch import Scratch
from stockyard.operators.skew import find_hot, lookup

#: Parts a task deals its groups over where more than one task is needed, and groups a task has in the mean.
WIDTH, FAN = 64, 4096

#: What makes texts equal: a hash, a checksum and the size together.
_SAME = ["text_hash", "text_crc32", "size"]


def differencing(sizes: list[int], parts: int) -> list[int]:
    """The part of each size. Of equal spreads the partial partition made first goes first."""
    heap, trees, ids = [], {}, iter(range(len(sizes), 2 * len(sizes)))
    for i, size in enumerate(sizes):
        heap.append((-size, i, [size] + [0] * (parts - 1)))  # parts by falling size, the least taken off all
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, left, a), (_, right, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = [x + y for x, y in zip(a, reversed(b))]
        order = sorted(range(parts), key=joined.__getitem__, reverse=True)
        least, node = joined[order[-1]], next(ids)
        trees[node] = left, right, order
        heapq.heappush(heap, (least - joined[order[0]], node, [joined[k] - least for k in order]))
    out = [0] * len(sizes)
    open_ = [(heap[0][1], list(range(parts)))] if heap else []
    while open_:
        node, labels = open_.pop()  # labels: the part that each place of the node, by falling size, belongs to
        if node < len(sizes):
            out[node] = labels[0]
            continue
        left, right, order = trees.pop(node)
        mine = [0] * parts
        for place, k in enumerate(order):
            mine[k] = labels[place]
        open_ += [(left, mine), (right, mine[::-1])]
    return out


def _dealt(groups: DataFrame, key: list[str], tasks: int, parts: int) -> DataFrame:
    """``key, weight, part``: the groups (``key, weight``) of each task dealt over ``parts``; part numbers go on from task to task."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.select(*key).schema)

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["weight", *key], ascending=[False] + [True] * len(key), ignore_index=True)
        rows["part"] = [int(rows["task"].iloc[0]) * parts + p for p in differencing(rows["weight"].tolist(), parts)]
        return rows[[*key, "weight", "part"]]

    task = F.pmod(F.xxhash64(F.lit(tasks), *key), F.lit(tasks)).alias("task")
    return groups.select(*key, "weight", task).groupBy("task").applyInPandas(deal, f"{kinds}, weight long, part long")


def balanced(groups: DataFrame, key: list[str], parts: int, scratch: Scratch, width: int = WIDTH, fan: int = FAN) -> DataFrame:
    """``key, weight, part`` for ``groups`` (``key, weight``): indivisible groups dealt over ``parts`` of nearly equal weight."""
    width = max(width, 8 * parts)
    fan = max(fan, 2 * width)
    now = scratch.keep(groups.select(*key, "weight"))
    rows, level, made = now.count(), key, None
    while True:
        tasks = math.ceil(rows / fan) or 1
        step = scratch.keep(_dealt(now, level, tasks, parts if tasks == 1 else width))
        scratch.drop(now)
        if made is not None:
            found = scratch.keep(made.join(step.select(F.col("item").alias("__item"), F.col("part").alias("__part")), F.col("part") == F.col("__item"))
                                 .select(*key, "weight", F.col("__part").alias("part")))
            scratch.drop(made, step)
            step = found
        if tasks == 1:
            return step
        made, level = step, ["item"]
        now = scratch.keep(step.groupBy(F.col("part").alias("item")).agg(F.sum("weight").alias("weight")))
        rows = now.count()


def shard_rows(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, fan: int = FAN) -> DataFrame:
    """One row per document: ``__row, doc_id, size, text_crc32, shard, slot``; ``slot`` is a row's place in its shard, from 0 without gaps.

    Texts are read once and not moved: their size, hash and checksum are. Rows of a text with very many copies are dealt over several
    tasks when they meet their shard. A slot is the rows of the shard in earlier buckets, about sqrt(rows) of them by a hash of the row's
    number, and the place in the row's own.
    """
    scratch, content = Scratch(docs.sparkSession), whole(F.col(f"`{text}`"))
    rows = scratch.keep(numbered(docs).select(
        ROW, F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(content) + 1).cast("long").alias("size"), F.crc32(content).alias("text_crc32"), F.xxhash64(content).alias("text_hash")))
    groups = rows.groupBy(*_SAME).agg(F.sum("size").alias("weight"))
    dealt = balanced(groups, _SAME, shards, scratch, width, fan)
    mine = dealt.select(F.col("text_hash").alias("h"), F.col("text_crc32").alias("c"), F.col("size").alias("s"), F.col("part").cast("int").alias("shard"))
    same = (F.col("text_crc32") == F.col("c")) & (F.col("size") == F.col("s"))
    hot = find_hot(rows, ["text_hash"])["text_hash"]
    buckets = 1 << max(1, math.ceil(math.log2(max(rows.count(), 2)) / 2))
    placed = scratch.keep(lookup(rows, mine, "text_hash", "h", also=same, hot=hot, spread=ROW)
                          .select(ROW, "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64(ROW), F.lit(buckets)).alias("bucket")))
    scratch.drop(rows, dealt)
    held = placed.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = held.select(F.col("shard").alias("of"), F.col("bucket").alias("at"), (F.sum("rows").over(upto) - F.col("rows")).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), ROW)
    return (placed.withColumn("place", F.row_number().over(inside))
            .join(starts, (F.col("shard") == F.col("of")) & (F.col("bucket") == F.col("at")))
            .select(ROW, "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place") - 1).alias("slot")))


def write_shards(docs: DataFrame, folder: str, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> None:
    """``docs`` as Parquet under ``folder``, a directory a shard (``shard=0``, …), all columns as they were, each file a run of slots in order."""
    row = unused(docs.columns, ROW)
    place = shard_rows(docs, shards, doc_id, text).select(F.col(ROW).alias(f"{row}_of"), F.col("shard").alias(f"{row}_shard"), F.col("slot").alias(f"{row}_slot"))
    dealt = numbered(docs, row).join(place, F.col(row) == F.col(f"{row}_of")).repartitionByRange(f"{row}_shard", f"{row}_slot").sortWithinPartitions(f"{row}_shard", f"{row}_slot")
    directory = unused(docs.columns, "shard")
    dealt.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{row}_shard").alias(directory)).write.partitionBy(directory).parquet(folder)
