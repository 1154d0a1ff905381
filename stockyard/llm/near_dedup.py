"""Near duplicates by weighted Jaccard similarity of word shingles: BagMinHash signatures, bands, exact verification.

A text is the multiset of its runs of five words. BagMinHash: each shingle and weight level is a Poisson process over time and weight, in
dyadic levels (0,1], (1,2], (2,4], … of the weight; a point belongs to a random register and counts if its weight lies below the shingle's count.
A register keeps its earliest point, so two texts agree in a register with the probability of their weighted Jaccard similarity. Points of
a process are drawn in order of time and only until they are later than every register's.

Texts with equal multisets are one class and only its first row goes on. Within a band's bucket no pairs are listed: every member is
compared with the bucket's first. What that leaves open (members that are not like the first, and those near enough to its limit that, by the triangle inequality of
the Jaccard distance, they could still be like one of these) is bucketed again by its rarest shingles, an exact prefix filter, and
compared round by round with the next few members of its buckets, until every bucket is one component or used up.

Defined results: words are runs without white space, in lower case; a text of one to four words is one shingle; NULL, empty and blank texts are one class;
repeated rows are copies; of a class the smallest ``doc_id`` stays (NULL last), of equal ones the first row; extra columns are not touched.
The input must be a plain reading of files.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockyard.llm.components import components, linked
from stockyard.llm.rows import ROW, numbered, whole, without
from stockyard.llm.scratch import Scratch

SHINGLE, SIMILAR = 5, 0.8
#: At a similarity of 0.8 a pair meets in a band with probability 0.9995.
BANDS, PER_BAND = 25, 6

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_REMEMBERED = 300_000
#: Members of a rare shingle's bucket that all others are compared with in the first round; each further round takes twice as many of the next ones.
_HEADS = 256


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    return x ^ (x >> np.uint64(32))


class _Hashes(dict):
    """Hash of each word, for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: the text's place, the shingle's hash, its count; sorted by place and hash."""
    split = [t.lower().split() for t in texts]
    lengths = np.array([len(s) for s in split], np.int64)
    total = int(lengths.sum())
    hashed = np.fromiter((_hashes[w] for s in split for w in s), np.uint64, total)
    owner = np.repeat(np.arange(len(texts)), lengths)
    ends = np.cumsum(lengths)
    # Position within the text, counted from its end: a full shingle begins where at least ``size`` words are left.
    left = np.repeat(ends, lengths) - np.arange(total)
    wide = _mixed(hashed)
    run = np.zeros(total, np.uint64)
    for k in range(size):
        part = np.zeros(total, np.uint64)
        part[:total - k] = wide[k:]
        part[left <= k] = 0  # a short text's only shingle ends with the text
        run = run * _GOLDEN + part
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if total else np.zeros(0, bool)
    keep = (left >= size) | (first & (left < size))
    owner, run = owner[keep], _mixed(run[keep])
    order = np.lexsort((run, owner))
    owner, run = owner[order], run[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (run[1:] != run[:-1])]) if len(run) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return owner[at], run[at], np.diff(np.append(at, len(run)))


def bag_min_hash(owner: np.ndarray, run: np.ndarray, count: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """Times of the earliest points, texts by registers; infinite for a text without shingles."""
    levels = np.where(count > 1, 1 + np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 1)
    text, weight = np.repeat(owner, levels), np.repeat(count, levels)
    level = np.arange(len(text)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0)).astype(np.float64)
    width = np.maximum(low, 1.0)
    seed = _mixed(np.repeat(run, levels) + level.astype(np.uint64) * _GOLDEN)
    rate = registers * width
    earliest = np.full(texts * registers, np.inf)
    time = np.zeros(len(text))
    while len(text):
        seed = seed + _GOLDEN
        drawn = _mixed(seed)
        other = _mixed(drawn + _GOLDEN)
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / rate
        inside = low + width * ((other >> np.uint64(32)).astype(np.float64) * 2.0 ** -32) < weight
        place = text * registers + ((other & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(earliest, place[inside], time[inside])
        active = time < earliest.reshape(texts, registers).max(1)[text]
        text, weight, low, width, seed, rate, time = (x[active] for x in (text, weight, low, width, seed, rate, time))
    return earliest.reshape(texts, registers)


def _runs(ids: list, texts: list[str], most: int = 1_500_000):
    """Runs of whole texts of about ``most`` code points, or one longer text."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if k > lo and size + len(t) > most:
            yield ids[lo:k], texts[lo:k]
            lo, size = k, 0
        size += len(t)
    if lo < len(texts):
        yield ids[lo:], texts[lo:]


def signatures(docs: DataFrame, text: str = "text", bands: int = BANDS, per_band: int = PER_BAND, size: int = SHINGLE) -> DataFrame:
    """``__row, weight, one, two, bands`` of every row: number of shingles, a 128-bit hash of the multiset, a hash of each band."""
    layout = pa.schema([(ROW, pa.int64()), ("weight", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                for ids, texts in _runs(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    owner, run, count = shingles(texts, size)
                    earliest = bag_min_hash(owner, run, count, len(texts), bands * per_band)
                    one, two = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
                    element = _mixed(run * _GOLDEN + count.astype(np.uint64))
                    np.add.at(one, owner, element)
                    np.add.at(two, owner, _mixed(element + _GOLDEN))
                    bits = earliest.view(np.uint64).reshape(len(texts), bands, per_band)
                    keys = np.full((len(texts), bands), 1, np.uint64) * np.arange(1, bands + 1, dtype=np.uint64)
                    for k in range(per_band):
                        keys = _mixed(keys * _GOLDEN + bits[:, :, k])
                    weight = np.bincount(owner, count, len(texts)).astype(np.int64)
                    lists = pa.ListArray.from_arrays(np.arange(0, len(texts) * bands + 1, bands, dtype=np.int32), keys.view(np.int64).ravel())
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(weight), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), lists], schema=layout)

    rows = numbered(docs).select(ROW, whole(F.col(f"`{text}`")).alias("text"))
    return rows.mapInArrow(work, f"{ROW} long, weight long, one long, two long, bands array<long>")


def _bags(rows: DataFrame, size: int) -> DataFrame:
    """``row, bag``: distinct shingle hashes and counts of each text, 64 bits each."""
    layout = pa.schema([("row", pa.int64()), ("bag", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                for ids, texts in _runs(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    owner, run, count = shingles(texts, size)
                    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                    bags = [run[a:b].tobytes() + count[a:b].astype("<u4").tobytes() for a, b in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bags, pa.binary())], schema=layout)

    return rows.mapInArrow(work, "row long, bag binary")


def _open(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(bag) // 12
    return np.frombuffer(bag, np.uint64, n), np.frombuffer(bag, "<u4", n, 8 * n).astype(np.int64)


def _similarity(one: bytes, other: bytes) -> float:
    (a, m), (b, n) = _open(one), _open(other)
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    both = b[at] == a if len(b) else np.zeros(len(a), bool)
    shared = int(np.minimum(m[both], n[at[both]]).sum())
    return shared / float(m.sum() + n.sum() - shared)


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """``rep, leader, similarity`` of the pairs."""
    layout = pa.schema([("rep", pa.int64()), ("leader", pa.int64()), ("similarity", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                like = [_similarity(a, b) for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(like, pa.float64())], schema=layout)

    mine = bags.select(F.col("row").alias("rep"), F.col("bag").alias("own"))
    theirs = bags.select(F.col("row").alias("leader"), F.col("bag").alias("other"))
    return pairs.join(mine, "rep").join(theirs, "leader").select("rep", "leader", "own", "other").mapInArrow(work, "rep long, leader long, similarity double")


def _links(verified: DataFrame, similar: float) -> DataFrame:
    return verified.where(F.col("similarity") >= similar).select(F.col("rep").alias("a"), F.col("leader").alias("b"))


def _placed(buckets: DataFrame, named: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their component."""
    members = buckets.join(named, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep")).drop("node")
    mixed = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select(F.col("key").alias("k"))
    return members.join(mixed, F.col("key") == F.col("k"), "left_semi")


def _round(left: DataFrame, turns: DataFrame, to: int, similar: float) -> DataFrame:
    """``rep, leader`` to compare: members of rare-shingle buckets with earlier ones of another component whose place is at most ``to``."""
    members = left.join(turns, "rep")
    heads = members.where(F.col("place") <= to).select(
        F.col("key").alias("k"), F.col("rep").alias("leader"), F.col("weight").alias("leads"), F.col("component").alias("joined"), F.col("place").alias("before"),
        F.col("ahead").alias("skipped"), F.col("turns").alias("other"))
    enough = F.least(F.col("weight") - F.col("ahead"), F.col("leads") - F.col("skipped")) >= similar / (1 + similar) * (F.col("weight") + F.col("leads")) - 1e-6
    apart = (F.col("before") < F.col("place")) & (F.col("component") != F.col("joined")) & (_bound() >= similar)
    first = F.element_at(F.array_intersect("turns", "other"), 1) == F.col("key")
    return members.join(heads, (F.col("key") == F.col("k")) & apart & enough & first).select("rep", "leader")


def _firsts(buckets: DataFrame) -> DataFrame:
    """Members of the buckets, each with its bucket's first member."""
    first = buckets.groupBy("key").agg(F.min(F.struct("rep", "weight")).alias("f"))
    return (buckets.join(first.select(F.col("key").alias("k"), F.col("f.rep").alias("leader"), F.col("f.weight").alias("leads")), F.col("key") == F.col("k"))
            .where("rep != leader").drop("k"))


def _bound() -> F.Column:
    """Similarity that two texts of these sizes can reach at most."""
    return F.least("weight", "leads") / F.greatest("weight", "leads")


def _open_members(members: DataFrame, verified: DataFrame, similar: float) -> DataFrame:
    """Members that the comparison with their bucket's first does not settle: ``rep, weight``."""
    known = members.join(verified, ["rep", "leader"], "left").withColumn("like", F.coalesce("similarity", _bound()))
    apart = known.where(F.col("like") < similar).groupBy("key").agg(F.min(1 - F.col("like")).alias("nearest")).select(F.col("key").alias("k"), "nearest")
    # A linked member is settled if it is nearer to the first than any unlinked one minus the greatest distance of a link.
    stays = (F.col("like") < similar) | (1 - F.col("like") >= F.col("nearest") - (1 - similar) - 1e-9)
    return known.join(apart, F.col("key") == F.col("k")).where(stays).select("rep", "weight").distinct()


def _prefixes(reps: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """Buckets by rare shingles: two texts at least this similar share one of the rarest shingles of each (``key, rep, weight, ahead, count, place``).

    ``ahead`` is the number of a member's shingles that come before this one in the order, rare ones first. A pair is compared only in the first bucket it
    shares, and only if what follows there in both is enough for the similarity: shingles before it are not shared.
    """
    layout = pa.schema([("rep", pa.int64()), ("weight", pa.int64()), ("key", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, weight, bag in zip(*(batch.column(k).to_pylist() for k in range(3))):
                run, count = _open(bag)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(run), rep)), pa.array(np.full(len(run), weight)), pa.array(run.view(np.int64))], schema=layout)

    each = reps.join(bags, F.col("rep") == F.col("row")).select("rep", "weight", "bag").mapInArrow(work, "rep long, weight long, key long")
    common = each.groupBy("key").count().where("count > 1")
    # Shingles of no other text cannot make a bucket but take up the first places of the order. A place counts once, however often
    # its shingle occurs, which only lengthens the prefix.
    shared = each.join(common, "key").withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("count", "key"))).withColumn("others", F.count("*").over(Window.partitionBy("rep")))
    kinds = each.groupBy("rep").agg(F.count("*").alias("kinds"))
    ahead = F.col("place") + F.col("kinds") - F.col("others") - 1
    prefix = shared.join(kinds, "rep").withColumn("ahead", ahead).where(F.col("ahead") <= F.col("weight") - F.ceil(F.col("weight") * similar))
    return prefix.select("key", "rep", "weight", "ahead", "count", F.row_number().over(Window.partitionBy("key").orderBy("rep")).alias("place"))


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR, bands: int = BANDS, per_band: int = PER_BAND, size: int = SHINGLE) -> DataFrame:
    """One row per document: ``__row, doc_id, class_id, class_size, kept``; ``class_id`` is the ``doc_id`` that stays."""
    scratch = Scratch(docs.sparkSession)
    signed = scratch.keep(signatures(docs, text, bands, per_band, size))
    same = signed.groupBy("weight", "one", "two").agg(F.min(ROW).alias("rep"))
    placed = scratch.keep(signed.select(ROW, "weight", "one", "two").join(same, ["weight", "one", "two"]).select(ROW, "weight", "rep"))
    reps = signed.join(placed.select("rep").distinct(), F.col(ROW) == F.col("rep"), "left_semi").where("weight > 0")
    key = F.xxhash64("at", "value")
    buckets = reps.select(F.col(ROW).alias("rep"), "weight", F.posexplode("bands").alias("at", "value")).select(key.alias("key"), "rep", "weight")
    shared = buckets.groupBy("key").count().where("count > 1").select("key")
    met = scratch.keep(buckets.join(shared, "key", "left_semi"))
    scratch.drop(signed)

    wanted = met.select(F.col("rep").alias("w")).distinct()
    texts = numbered(docs).select(F.col(ROW).alias("row"), whole(F.col(f"`{text}`")).alias("text")).join(wanted, F.col("row") == F.col("w"), "left_semi")
    bags = scratch.keep(_bags(texts, size))

    members = scratch.keep(_firsts(met))
    verified = scratch.keep(_verified(members.where(_bound() >= similar).select("rep", "leader").distinct(), bags))
    named = components(_links(verified, similar), scratch)
    rare = scratch.keep(_prefixes(_open_members(members, verified, similar), bags, similar))
    scratch.drop(met, members)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("count", "key"))), lambda x: x["key"])
    turns = scratch.keep(rare.groupBy("rep").agg(in_order.alias("turns")))
    done, heads = 0, _HEADS
    while True:
        left = scratch.keep(_placed(rare.where(F.col("place") > done), named))
        if left.isEmpty():
            break
        found = scratch.keep(_verified(_round(left, turns, done + heads, similar).join(verified, ["rep", "leader"], "left_anti"), bags))
        named = linked(named, _links(found, similar), scratch)
        scratch.drop(left, found)
        done, heads = done + heads, 2 * heads
    scratch.drop(left, bags, verified, rare, turns)

    rows = numbered(docs).select(ROW, F.col(f"`{doc_id}`").alias("doc_id")).join(placed, ROW)
    rows = rows.join(named, F.col("rep") == F.col("node"), "left").withColumn("class", F.coalesce("component", "rep"))
    # Stored, so that a class of very many rows is split where its rows meet its first.
    rows = scratch.keep(rows.select(ROW, "doc_id", "class"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col(ROW).alias("r"))
    best = rows.groupBy("class").agg(F.min(order).alias("b"), F.count("*").alias("class_size")).select(F.col("class").alias("c"), F.col("b.d").alias("class_id"), F.col("b.r").alias("keeps"), "class_size")
    best = scratch.keep(best)
    scratch.drop(placed, named)
    return rows.join(best, F.col("class") == F.col("c")).select(ROW, "doc_id", "class_id", "class_size", (F.col(ROW) == F.col("keeps")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class; all columns as they were."""
    return without(docs, near_classes(docs, doc_id, text, **options).where(~F.col("kept")))
