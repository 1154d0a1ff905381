"""Language identification with interpolated Kneser-Ney character models.

Every language has a model of order four over the letters of a word with a blank at both ends. Counts of all training texts are
summed by Spark; lower orders count in how many different left neighbours a sequence follows, except for sequences at a word's start,
which have none. The models of all languages are sorted arrays of packed sequences; a worker scores
the distinct words of a batch together. The language with the lowest cross-entropy per letter wins.

Workers hold the most frequent sequences, at most ``MOST_SENT`` of all languages together, 16 bytes each, and a bit map of fixed size of the others.
A place in a text that needs one of the others is left open and handed on as its last four letters, which settle it; all open places of the corpus
are looked up in the stored model by a join and added to their texts. So every sequence counts, however many there are. What grows with the number of languages, and with that
alone, is a number a language and text.

Defined results: a NULL text or one without a letter is ``und`` with score 0, as is every text if nothing could be learned; equal cross-entropies go to the
language first by code point; letters outside the basic plane count as two; repeated rows count as often as they occur; extra columns are not touched.
"""

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.bitmaps import bit_map, mixed
from stockyard.llm.rows import ROW, numbered, whole
from stockyard.llm.scratch import Scratch
from stockyard.operators.skew import find_hot, lookup
from stockyard.sources.shared_dir import cut_lineage

ORDER, MOST_SENT, UNKNOWN = 4, 2_000_000, "und"
#: A text is rejected as no language if its cross-entropy is this many bits a letter above nearly all training texts of its language.
MARGIN_BITS, QUANTILE, LEAST_LETTERS = 1.0, 0.999, 40

_WORD = re.compile(r"[^\W\d_]+")
_DISTINCT = 150_000
_MASK = (1 << 48) - 1
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _codes(some: list[str]) -> np.ndarray:
    """All words in a row as 16-bit codes, a blank before, between and after them."""
    return np.frombuffer(f" {' '.join(some)} ".encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)


def _packed(codes: np.ndarray, size: int) -> np.ndarray:
    """Each run of ``size`` codes as one number, by its last position; the first ``size - 1`` positions are left out."""
    out = np.zeros(len(codes) - size + 1, np.uint64)
    for k in range(size):
        out = (out << np.uint64(16)) | codes[k:len(codes) - size + 1 + k]
    return out


def _reach(codes: np.ndarray) -> np.ndarray:
    """How many codes back the blank before each position lies."""
    at = np.arange(len(codes))
    blank = np.maximum.accumulate(np.where(codes == 32, at, 0))
    before = np.concatenate([[0], blank[:-1]])
    return at - before


def _grams(counted: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Packed sequences of order four, and shorter ones at a word's start, with their counts."""
    some = list(counted)
    codes = _codes(some)
    weights = np.fromiter(counted.values(), np.int64, len(some))
    # The word that each position belongs to; the blank after a word counts as its end.
    owner = np.repeat(np.arange(len(some)), np.diff(np.flatnonzero(codes == 32)))
    weight, reach = np.concatenate([[0], weights[owner]]), _reach(codes)
    keys, counts = [], []
    for size in range(2, ORDER + 1):
        packed, far, n = _packed(codes, size), reach[size - 1:], weight[size - 1:]
        keep = far >= size - 1 if size == ORDER else far == size - 1
        keys.append(packed[keep])
        counts.append(n[keep])
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``lang, text``; ``n`` summed per task before the shuffle."""
    layout = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def flushed():
            for lang, counted in seen.items():
                if counted:
                    key, n = _grams(counted)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key.view(np.int64)), pa.array(n)], schema=layout)
            seen.clear()

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    seen.setdefault(lang, Counter()).update(words(text))
                if sum(map(len, seen.values())) > _DISTINCT:
                    yield from flushed()
        yield from flushed()

    return labelled.mapInArrow(work, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _size(gram: Column) -> Column:
    """How many codes a sequence of two and more has."""
    return F.when((gram < 0) | (gram > _MASK), 4).when(gram > (1 << 32) - 1, 3).otherwise(2)


def _tables(counts: DataFrame) -> DataFrame:
    """``lang, gram, n`` of all orders: raw at the top and at word starts, else the number of different left neighbours."""
    levels = [cut_lineage(counts)]
    sized = levels[0].withColumn("size", _size(F.col("gram")))
    above, out = sized.where("size = 4"), []
    for size in (3, 2, 1):
        out.append(above)
        below = above.select("lang", F.col("gram").bitwiseAND((1 << (16 * size)) - 1).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))
        starts = sized.where(F.col("size") == size).select("lang", "gram", "n")
        above = below.unionByName(starts).groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("size", F.lit(size))
    out.append(above)
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every


class Model(NamedTuple):
    """``sent`` is what workers hold; ``entries`` is the whole model, stored: ``lang, gram, n, share, left``."""

    sent: dict
    entries: DataFrame


def _entries(grams: DataFrame) -> DataFrame:
    """Per language and sequence its discounted share among those of the same beginning, and the weight that it, as a beginning, leaves to shorter ones."""
    ones = grams.groupBy("lang", "size").agg(F.count_if(F.col("n") == 1).alias("a"), F.count_if(F.col("n") == 2).alias("b"))
    cut = ones.select("lang", "size", F.when((F.col("a") > 0) & (F.col("b") > 0), F.col("a") / (F.col("a") + 2 * F.col("b"))).otherwise(0.5).alias("cut"))
    rows = grams.join(F.broadcast(cut), ["lang", "size"]).withColumn("context", F.shiftrightunsigned("gram", 16))
    totals = rows.groupBy("lang", "size", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.first("cut").alias("c"))
    shares = rows.join(totals.drop("c"), ["lang", "size", "context"]).select(
        "lang", "gram", "n", ((F.col("n") - F.col("cut")) / F.col("total")).cast("float").alias("share"), F.lit(None).cast("float").alias("left"))
    left = totals.select("lang", F.col("context").alias("gram"), F.col("total").alias("n"), F.lit(None).cast("float").alias("share"),
                         (F.col("c") * F.col("kinds") / F.col("total")).cast("float").alias("left"))
    both = shares.unionByName(left).groupBy("lang", "gram").agg(F.max("n").alias("n"), F.max("share").alias("share"), F.max("left").alias("left"))
    return both.select("lang", "gram", "n", F.coalesce("share", F.lit(0.0)).cast("float").alias("share"), F.coalesce("left", F.lit(1.0)).cast("float").alias("left"))


def _entry_hash(grams: np.ndarray, place: int | np.ndarray) -> np.ndarray:
    return mixed(grams * _GOLDEN + np.asarray(place).astype(np.uint64))


def _hashed(entries: DataFrame) -> DataFrame:
    """Hashes of ``place, gram``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = _entry_hash(batch.column(1).to_numpy().view(np.uint64), batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["hash"])

    return entries.select("place", "gram").mapInArrow(work, "hash long")


def train(labelled: DataFrame, most_sent: int = MOST_SENT) -> Model:
    """Model from all rows of ``lang, text``.

    Workers get the sequences of the highest counts, in whole quarters of a power of two, while they number at most ``most_sent``.
    """
    grams = cut_lineage(_tables(gram_counts(labelled)))
    entries = Scratch(labelled.sparkSession).keep(_entries(grams))
    langs = sorted((r.lang for r in entries.select("lang").distinct().collect()), key=lambda x: x.encode("utf-8", "surrogatepass"))
    model = {"langs": langs, "arrays": [], "uniform": 1.0 / max(2, grams.where("size = 1").count()), "others": None}
    if not langs:
        return Model(model, entries)
    band = F.floor(F.log2("n") * 4).cast("int")
    held = {r.band: r.rows for r in entries.groupBy(band.alias("band")).agg(F.count("*").alias("rows")).collect()}
    least, left_out = max(held) + 1, sum(held.values())
    for level in sorted(held, reverse=True):
        if sum(held.values()) - left_out + held[level] > most_sent:
            break
        least, left_out = level, left_out - held[level]
    placed = entries.withColumn("place", _place(langs, F.col("lang")))
    rows = placed.where(band >= least).select("place", "gram", "share", "left").toPandas()
    rows["gram"] = rows["gram"].to_numpy(np.int64).view(np.uint64)
    for place in range(len(langs)):
        some = rows[rows["place"] == place].sort_values("gram")
        model["arrays"].append((some["gram"].to_numpy(np.uint64), some["share"].to_numpy(np.float32), some["left"].to_numpy(np.float32)))
    if left_out:
        model["others"] = bit_map(_hashed(placed.where(band < least)), "hash")
    return Model(model, entries)


def _place(langs: list[str], lang: Column) -> Column:
    return (F.array_position(F.array(*map(F.lit, langs)), lang) - 1).cast("int")


class Scorer:
    """Bits of texts in each language; the words of a batch are scored together and remembered."""

    def __init__(self, sent: dict):
        self.model = sent
        self.known: dict[str, int] = {}
        self.bits = np.zeros((0, len(sent["langs"])), np.float32)
        #: Of words with open places, the last letters at these.
        self.open: dict[str, np.ndarray] = {}

    def _at(self, place: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | bool]:
        """Share and weight left of sequences in a language, and which of them only the whole model knows."""
        grams, share, left = self.model["arrays"][place]
        others = self.model["others"]
        if len(grams):
            at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
            there = grams[at] == keys
            shares, rest = np.where(there, share[at], np.float32(0)), np.where(there, left[at], np.float32(1))
        else:
            there, shares, rest = np.zeros(len(keys), bool), np.zeros(len(keys), np.float32), np.ones(len(keys), np.float32)
        return shares, rest, False if others is None else ~there & others.holds(_entry_hash(keys, place))

    def _word_bits(self, some: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Bits of words in each language but for their open places, and the last letters at these."""
        codes = _codes(some)
        reach = _reach(codes)[1:]
        letters, nothing = codes[1:], np.zeros(1, np.uint64)
        # For each order the places that reach so far back, the sequences that end there and their beginnings.
        levels, last = [], np.zeros(len(letters), np.uint64)
        for size in range(2, ORDER + 1):
            rows = np.flatnonzero(reach >= size - 1)
            gram = _packed(codes, size)[rows - (size - 2)]
            last[rows] = gram
            levels.append((rows, gram, gram >> np.uint64(16)))
        bits, is_open = np.zeros((len(letters), len(self.model["langs"])), np.float32), np.zeros(len(letters), bool)
        for place in range(len(self.model["langs"])):
            share, _, hidden = self._at(place, letters)
            _, rest, none_hidden = self._at(place, nothing)
            p = share.astype(np.float64) + float(rest[0]) * self.model["uniform"]
            is_open |= hidden | (none_hidden if none_hidden is False else none_hidden[0])
            for rows, gram, context in levels:
                share, _, hidden = self._at(place, gram)
                _, rest, context_hidden = self._at(place, context)
                p[rows] = share + rest * p[rows]
                is_open[rows] |= hidden | context_hidden
            bits[:, place] = -np.log2(np.maximum(p, 1e-30))
        bits[is_open] = 0
        starts = np.flatnonzero(codes == 32)[:-1]
        opened = {}
        if is_open.any():
            at = np.flatnonzero(is_open)
            owner = np.searchsorted(starts, at, "right") - 1
            edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            opened = {some[owner[lo]]: keys for lo, keys in zip(edges, np.split(last[at], edges[1:]))}
        return np.add.reduceat(bits, starts, axis=0).astype(np.float32), opened

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Bits of each text in each language, its number of letters (a word's end counts as one), and the open places: their last letters and how often these occur."""
        split = [words(t) for t in texts]
        distinct = set().union(*split)
        new = distinct - self.known.keys()
        if len(self.known) + len(new) > 2 * _DISTINCT:
            keep = [w for w in distinct - new if len(w) <= 64]
            self.bits = self.bits[[self.known[w] for w in keep]]
            self.known = {w: i for i, w in enumerate(keep)}
            self.open = {w: self.open[w] for w in keep if w in self.open}
            new = distinct - self.known.keys()
        fresh = list(new)
        if fresh:
            first = len(self.bits)
            bits, opened = self._word_bits(fresh)
            self.bits = np.concatenate([self.bits, bits])
            self.open.update(opened)
            self.known.update(zip(fresh, range(first, first + len(fresh))))
        totals, letters = np.zeros((len(texts), len(self.model["langs"]))), np.zeros(len(texts), np.int64)
        places = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * len(texts)
        for k, some in enumerate(split):
            if some and any(any(c.isalpha() for c in w) for w in some):
                totals[k] = self.bits[np.fromiter(map(self.known.__getitem__, some), np.int64, len(some))].sum(0, dtype=np.float64)
                letters[k] = sum(map(len, some)) + len(some)
                opened = [self.open[w] for w in some if w in self.open] if self.open else []
                if opened:
                    places[k] = np.unique(np.concatenate(opened), return_counts=True)
        return totals, letters, places


_scorers: dict = {}


def _scored(docs: DataFrame, model: Model, text: Column, carried: tuple) -> DataFrame:
    """``carried, totals, letters, grams, counts`` of each row: ``totals`` are the bits in each language without the open places, of which ``grams`` has the last letters."""
    sent, key = docs.sparkSession.sparkContext.broadcast(model.sent), uuid.uuid4().hex
    read = docs.select(F.struct(*carried).alias("carried"), whole(text).alias("text"))
    layout = T.StructType([read.schema["carried"], T.StructField("totals", T.ArrayType(T.DoubleType())), T.StructField("letters", T.LongType()),
                           T.StructField("grams", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))])

    def listed(parts: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)]).astype(np.int32), pa.array(np.concatenate(parts)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(sent.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                totals, letters, places = _scorers[key].entropies(rows.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([rows.column(0), listed(list(totals)), pa.array(letters), listed([g.view(np.int64) for g, _ in places]), listed([n for _, n in places])],
                                                 ["carried", "totals", "letters", "grams", "counts"])

    return read.mapInArrow(work, layout)


def _open_bits(grams: DataFrame, model: Model) -> DataFrame:
    """``gram, bits``: for distinct last letters, their bits in each language by the whole model."""
    ends = grams.select("gram", F.explode(F.sequence(F.lit(1), _size(F.col("gram")))).alias("size"))
    end = F.when(F.col("size") == ORDER, F.col("gram")).otherwise(F.expr("gram & (shiftleft(1L, 16 * size) - 1)"))
    wanted = ends.select("gram", "size", F.explode(F.array(F.struct(F.lit("share").alias("role"), end.alias("want")), F.struct(F.lit("left").alias("role"), F.shiftrightunsigned(end, 16).alias("want")))).alias("w"))
    wanted = wanted.select("gram", "size", "w.role", "w.want")
    known = model.entries.select(F.col("gram").alias("of"), _place(model.sent["langs"], F.col("lang")).alias("place"), "share", "left")
    found = lookup(wanted, known, "want", "of", hot=find_hot(wanted, ["want"])["want"], spread="gram")
    value = lambda role, size: F.max(F.when((F.col("role") == role) & (F.col("size") == size), F.col(role)))
    sizes = range(1, ORDER + 1)
    # Every language knows how often it has any letter at all, so that each has a row for each of ``gram``.
    wide = found.where("place IS NOT NULL").groupBy("gram", "place").agg(
        *[F.coalesce(value("share", k), F.lit(0.0)).cast("double").alias(f"share{k}") for k in sizes], *[F.coalesce(value("left", k), F.lit(1.0)).cast("double").alias(f"left{k}") for k in sizes])
    p = F.lit(model.sent["uniform"])
    for k in sizes:
        longer = F.col(f"share{k}") + F.col(f"left{k}") * p
        p = longer if k < 3 else F.when(_size(F.col("gram")) >= k, longer).otherwise(p)
    return _by_place(wide.select("gram", "place", (-F.log2(F.greatest(p, F.lit(1e-30)))).alias("bits")), "gram", "bits")


def _by_place(rows: DataFrame, key: str, value: str) -> DataFrame:
    """One array a ``key`` of the values of all languages, in their order."""
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", value))), lambda x: x[value]).alias(value))


def _settled(scored: DataFrame, model: Model) -> DataFrame:
    """``carried, totals, letters`` with the open places of all texts looked up in the stored model."""
    if model.sent["others"] is None:  # workers hold the whole model, no place is open
        return scored.select("carried", "totals", "letters")
    kept = Scratch(scored.sparkSession).keep(scored.withColumn("at", F.monotonically_increasing_id()))
    each = kept.select("at", F.explode(F.arrays_zip("grams", "counts")).alias("o")).select("at", F.col("o.grams").alias("gram"), F.col("o.counts").alias("n"))
    bits = _open_bits(each.select("gram").distinct(), model).withColumnRenamed("gram", "of")
    met = lookup(each.withColumn("spread", F.col("at")), bits, "gram", "of", hot=find_hot(each, ["gram"])["gram"], spread="spread")
    # Decimals, whose sums do not depend on the order of the rows.
    more = met.select("at", "n", F.posexplode("bits").alias("place", "each_bits")).groupBy("at", "place").agg(
        F.sum((F.col("n") * F.col("each_bits")).cast("decimal(28,12)")).cast("double").alias("more"))
    opened = kept.where(F.size("grams") > 0).join(_by_place(more, "at", "more"), "at")
    return kept.where(F.size("grams") == 0).select("carried", "totals", "letters").unionByName(
        opened.select("carried", F.zip_with("totals", "more", lambda a, b: a + b).alias("totals"), "letters"))


def identified(docs: DataFrame, model: Model, text: Column, *carried: Column | str) -> DataFrame:
    """Columns ``carried`` of each row, and ``lang, score, bits, letters``: best language, its share of the likelihood over 50 letters, cross-entropy and length."""
    langs = model.sent["langs"]
    if not langs:
        return docs.select(*carried, F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"), F.lit(0).cast("long").alias("letters"))
    low, letters, none = F.array_min("totals"), F.col("letters"), F.col("letters") == 0
    part = F.aggregate("totals", F.lit(0.0), lambda a, t: a + F.pow(F.lit(2.0), (low - t) / letters * F.least(letters, F.lit(50))))
    return _settled(_scored(docs, model, text, carried), model).select(
        "carried.*", F.when(none, UNKNOWN).otherwise(F.element_at(F.array(*map(F.lit, langs)), F.array_position("totals", low).cast("int"))).alias("lang"),
        F.when(none, 0.0).otherwise(1 / part).alias("score"), F.when(~none, low / letters).alias("bits"), "letters")


def learnable(docs: DataFrame) -> Column:
    """Whether a document may be learned from: not held out, and its language is known."""
    return F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def language_rejects(docs: DataFrame) -> DataFrame:
    """Row numbers of documents that are in none of the languages: without letters, or of at least ``LEAST_LETTERS`` letters
    and with a cross-entropy ``MARGIN_BITS`` above the ``QUANTILE`` of the training texts. Without labels none is rejected."""
    model = train(docs.where(learnable(docs)).select("lang", whole(F.col("text")).alias("text")))
    if not model.sent["langs"]:  # nothing was learned, so nothing can be rejected
        return numbered(docs).where("false").select(ROW)
    judged = cut_lineage(identified(numbered(docs), model, F.col("text"), ROW, learnable(docs).alias("__learned")))
    limits = judged.where(F.col("__learned") & F.col("bits").isNotNull()).groupBy("lang").agg((F.percentile_approx("bits", QUANTILE, 1000) + MARGIN_BITS).alias("__limit"))
    high = F.col("bits") > F.col("__limit")
    # A row a language.
    return judged.join(F.broadcast(limits), "lang", "left").where((F.col("letters") == 0) | ((F.col("letters") >= LEAST_LETTERS) & high)).select(ROW)
