"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest of its inner s-mers, by hash, lies at its first
or last place. That depends on the k-mer alone, so equal passages have equal anchors wherever they
stand, and a window of k - s neighbouring k-mers always holds one. ``anchors`` gives all of them with their
positions, for positional matching; ``fingerprint`` keeps the smallest hashes of a text, the usual bottom sketch, as a hex string.

Defined results: NULL is an empty text; the empty text has the empty fingerprint, which is like only itself; a
text shorter than k, or without a closed syncmer, is one anchor as a whole; k is the same for all others, so that a short passage shares its anchors with
any text that holds it; repeated rows are texts of their own; extra columns are not touched.
"""

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.rows import ROW, numbered, whole
from stockyard.sources.shared_dir import cut_lineage

K, S, SKETCH = 16, 8, 128

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    return x ^ (x >> np.uint64(32))


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n codes; n is built from its binary digits."""
    out, done, power, block = None, 0, codes, 1
    while n:
        if n & 1:
            out = power if out is None else _mixed(out[: len(out) - block] * _MULTIPLY + power[done:])
            done += block
        n >>= 1
        if n:
            power = _mixed(power[:-block] * _MULTIPLY + power[block:])
            block *= 2
    return out


def _smallest(a: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width``."""
    done = 1
    while done * 2 <= width:
        a = np.minimum(a[:-done], a[done:])
        done *= 2
    return a if done == width else np.minimum(a[: len(a) - (width - done)], a[width - done:])


def syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions in code points and 64-bit hashes of the closed syncmers of ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    codes = _mixed(codes + _MULTIPLY)
    if len(codes) >= k:
        inner = _grams(codes, s)
        lowest = _smallest(inner, k - s + 1)
        at = np.flatnonzero((inner[: len(lowest)] == lowest) | (inner[k - s:] == lowest))
        if len(at):
            return at, _grams(codes, k)[at]
    return np.zeros(1, np.int64), _grams(codes, len(codes))


def fingerprint(text: str, k: int = K, s: int = S, size: int = SKETCH) -> str:
    """The ``size`` smallest distinct 32-bit hashes of the anchors, ascending, eight hex digits each."""
    hashes = (syncmers(text, k, s)[1] >> np.uint64(32)).astype(np.uint32)
    least = hashes
    if len(hashes) > 4 * size:  # the smallest alone, repeats counted; they do if enough of them are distinct
        least = hashes[hashes <= np.partition(hashes, 4 * size - 1)[4 * size - 1]]
    distinct = np.unique(least)
    if len(distinct) < size and len(least) < len(hashes):
        distinct = np.unique(hashes)
    return distinct[:size].astype(">u4").tobytes().hex()


def likeness(one: str, other: str, size: int = SKETCH) -> float:
    """Estimated share of common anchors among all: of the smallest hashes of both together, how many are in both."""
    if one == other:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(x), ">u4") for x in (one, other))
    both = np.union1d(a, b)[:size]
    return float(len(np.intersect1d(np.intersect1d(a, b, True), both, True)) / len(both)) if len(both) else 1.0


def anchors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, positions, hashes``: every anchor of every document."""
    @F.pandas_udf("positions array<long>, hashes array<long>")
    def found(texts: pd.Series) -> pd.DataFrame:
        pairs = [syncmers(t) for t in texts]
        return pd.DataFrame({"positions": [p for p, _ in pairs], "hashes": [h.view(np.int64) for _, h in pairs]})

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), found(whole(F.col(f"`{text}`"))).alias("__a")).select("doc_id", "__a.*")


def beside_next(docs: DataFrame, judge, schema: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows that ``judge(rows)`` yields from each document with the next one, by descending ``doc_id`` (NULL last); after the last comes the first.

    ``judge`` gets an iterator of ``(doc_id, text, next_text)``. Documents are dealt once into runs of neighbours, of
    about equal counts whatever the ids are: the borders are those of ranges of (id, row), so rows of one id may lie in several runs. A run
    also gets the first document of the following run. A task holds two documents at a time.
    Per run its first place reaches the driver; the number of runs is four a shuffle partition.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = numbered(docs).select(ROW, F.col(f"`{doc_id}`").cast("long").alias("id"), whole(F.col(f"`{text}`")).alias("text"))
    # By descending id, NULL last, then row; the complement turns the order of ids without overflow.
    place = [F.col("id").isNull().alias("none"), F.coalesce(F.bitwise_not("id"), F.lit(0).cast("long")).alias("turned"), F.col(ROW)]
    ranges = cut_lineage(base.select(*place).repartitionByRange(4 * parts, "none", "turned", ROW))
    firsts = sorted(tuple(r["h"]) for r in ranges.groupBy(F.spark_partition_id()).agg(F.min(F.struct("none", "turned", ROW)).alias("h")).collect())

    @F.pandas_udf("int")
    def of(none: pd.Series, turned: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(firsts, key) - 1 for key in zip(none.tolist(), turned.tolist(), row.tolist())], dtype="int32")

    placed = base.withColumn("run", of(*place))
    before = {first[2]: (i or len(firsts)) - 1 for i, first in enumerate(firsts)}
    heads = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(F.lit(-1).cast("long"), F.lit(0))
    also = F.element_at(heads, F.col(ROW))
    twice = placed.select("id", "text", ROW, F.explode(F.filter(F.array(F.struct(F.col("run"), F.lit(False).alias("after")), F.struct(also.alias("run"), F.lit(True).alias("after"))), lambda x: x["run"].isNotNull())).alias("at"))
    dealt = (twice.select("at.run", "at.after", "id", ROW, "text").repartition(parts, "run")
             .sortWithinPartitions("run", "after", F.col("id").desc_nulls_last(), ROW).select("run", "after", "id", "text"))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for row in batch.slice(lo, 256).to_pylist():
                    if held is not None and held["run"] == row["run"]:
                        yield held["id"], held["text"], row["text"]
                    held = None if row["after"] else row

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row in judge(paired(batches)):
            out.append(row)
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return dealt.mapInArrow(work, schema)
