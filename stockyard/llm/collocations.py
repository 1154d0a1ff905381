"""Phrases whose words belong together, per language, by the partition method for frequent itemsets (SON).

A phrase that occurs ``support`` times in a language occurs, in at least one of several shards, as often as that shard's share
of the language's words lets expect. So each shard is mined completely at the support lowered in proportion, the phrases frequent in some shard
are united, and then all of these are counted over the whole corpus. A shard is a hash class of files, not a task: with one shard a task
the support of every shard would be one, and nothing would be left out. A shard is mined by as many tasks as the input has.

Three scans: words, with the sizes of the shards; phrases of frequent words, in each shard, by a hash; phrases that were frequent in some shard, whole.
What a scan needs to know of the one before are two bit maps of fixed size, of frequent words and of phrases frequent in a shard. A bit
set by chance lets a rare phrase be counted, nothing more: only exact counts of whole phrases decide. A task counts
its own rows before anything moves, in blocks of about ``BLOCK`` words or one longer text. The last scan counts a phrase only if its beginning
may be frequent in a shard too, as it is whenever the phrase is.

Defined results: NULL and empty texts have no words; a NULL language is ``und``; A to Z are lower-cased, no other letter; a word is a run without blank and tab, and a
phrase does not go over ``.,;:!?`` or a line end; repeated rows count as often as they occur; ties go by phrase in the order of UTF-8 bytes; an empty table has no phrases;
extra columns are not touched.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockyard.llm.bitmaps import BitMap, bit_map, mixed
from stockyard.llm.rows import shard_of, whole
from stockyard.llm.scratch import Scratch
from stockyard.operators.skew import find_hot, lookup

UNKNOWN = "und"
SHARDS, BLOCK = 4, 3_000_000
#: Phrases hashed, named and handed to Spark together.
_SENT = 1 << 16
#: Upper to lower case, tab to blank, and all that ends a piece to a line end.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_SLICE = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _tokens(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, a line end where a piece ends and empty strings between blanks, some at a time."""
    data, start = text.encode("utf-8", "surrogatepass").translate(_BYTES), 0
    while start < len(data):
        end = data.find(b" ", start + _SLICE) if start + _SLICE < len(data) else len(data)
        end = len(data) if end < 0 else end
        yield data[start:end].replace(b"\n", b" \n ").split(b" ")
        start = end


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)


class _Words(dict):
    """Numbers from 1 for the words of a block in one language; 0 ends a piece, as do words that are not wanted."""

    def __init__(self, lang: str, wanted: BitMap | None):
        super().__init__({b"": -1, b"\n": 0})
        self.seed, self.wanted, self.names, self.hashes = _seed(lang), wanted, [b""], [0]

    def __missing__(self, word: bytes) -> int:
        number = len(self.names)
        if self.wanted is not None:
            digest = xxhash.xxh64_intdigest(word, self.seed)
            if digest not in self.wanted:
                self[word] = 0
                return 0
            self.hashes.append(digest)
        self.names.append(word)
        self[word] = number
        return number

    def numbers(self, text: str) -> np.ndarray:
        parts = [np.fromiter(map(self.__getitem__, some), np.int32, len(some)) for some in _tokens(text)]
        whole_text = np.concatenate([*parts, np.zeros(1, np.int32)])
        return whole_text[whole_text >= 0]


class _Block:
    """Texts read together: the words of each language, and the number sequences of each of its shards."""

    def __init__(self, wanted: BitMap | None):
        self.wanted, self.words, self.sequences, self.size = wanted, {}, {}, 0

    def add(self, lang: str, shard: int, text: str) -> None:
        words = self.words.get(lang)
        if words is None:
            words = self.words[lang] = _Words(lang, self.wanted)
        numbers = words.numbers(text)
        self.sequences.setdefault((lang, shard), []).append(numbers)
        self.size += len(numbers)

    def release(self) -> None:
        """Forget all; who asked for the block still holds it while the next one grows."""
        self.words, self.sequences = {}, {}

    def joined(self) -> Iterator[tuple[str, int, _Words, np.ndarray]]:
        for (lang, shard), parts in self.sequences.items():
            yield lang, shard, self.words[lang], np.concatenate(parts)


def _phrases(sequence: np.ndarray, longest: int, wanted=None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: places where each distinct phrase begins, and its occurrences. Phrases of a length are numbered to find those of the next.

    ``wanted`` tells of which places, for a length, the phrases and the longer ones that begin with them are counted.
    """
    number, at = sequence, np.flatnonzero(sequence > 0)
    for size in range(2, longest + 1):
        at = at[at + size <= len(sequence)]
        at = at[sequence[at + size - 1] > 0]
        if wanted is not None and len(at):
            at = at[np.concatenate([wanted(at[lo:lo + _SENT], size) for lo in range(0, len(at), _SENT)])]
        if not len(at):
            return
        # By hand rather than by np.unique, which keeps several more arrays of this length at once.
        pairs = (number[at].astype(np.int64) << 32) | sequence[at + size - 1]
        order = np.argsort(pairs)
        pairs = pairs[order]
        begins = np.concatenate([[True], pairs[1:] != pairs[:-1]])
        del pairs
        edges = np.flatnonzero(begins)
        if size < longest:
            number = np.zeros(len(sequence), np.int32)
            number[at[order]] = np.cumsum(begins, dtype=np.int32)
        first = at[order[edges]]
        del order, begins
        yield size, first, np.diff(edges, append=len(at))


def _parts(sequence: np.ndarray, longest: int, wanted=None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``_phrases``, at most ``_SENT`` at a time, so that their hashes and names are never all in memory."""
    for size, starts, count in _phrases(sequence, longest, wanted):
        for lo in range(0, len(starts), _SENT):
            yield size, starts[lo:lo + _SENT], count[lo:lo + _SENT]


def _hashes(sequence: np.ndarray, starts: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    out = np.full(len(starts), size, np.uint64)
    for k in range(size):
        out = mixed(out * _GOLDEN + known[sequence[starts + k]])
    return out


def _blocks(batches: Iterator[pa.RecordBatch], wanted: BitMap | None, shards: bool) -> Iterator[_Block]:
    block = _Block(wanted)
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256)
            for lang, shard, text in zip(*(rows.column(k).to_pylist() for k in range(3))):
                block.add(lang, shard if shards else 0, text)
                if block.size >= BLOCK:
                    yield block
                    block.release()
                    block = _Block(wanted)
    if block.size:
        yield block


def _word_counts(texts: DataFrame) -> DataFrame:
    """``lang, shard, word, n`` of every block: a row per word without a shard, and one per shard without a word, with all its words."""
    layout = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, None, True):
            counts = {lang: np.zeros(len(words.names), np.int64) for lang, words in block.words.items()}
            totals = []
            for lang, shard, words, sequence in block.joined():
                here = np.bincount(sequence, minlength=len(words.names))
                counts[lang] += here
                totals.append((lang, shard, int(here[1:].sum())))
            for lang, words in block.words.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(words.names) - 1), pa.string()), pa.nulls(len(words.names) - 1, pa.int32()),
                                                  pa.array(words.names[1:], pa.binary()).cast(pa.string()), pa.array(counts[lang][1:])], schema=layout)
            langs, of, n = zip(*totals)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(of, pa.int32()), pa.nulls(len(n), pa.string()), pa.array(n, pa.int64())], schema=layout)

    return texts.mapInArrow(work, "lang string, shard int, word string, n long")


def _mined(texts: DataFrame, frequent, longest: int) -> DataFrame:
    """``hash, place, n`` of every block: phrases of frequent words by hash; a place is a shard of a language."""
    layout = pa.schema([("hash", pa.int64()), ("place", pa.int64()), ("n", pa.int64())])

    def rows(block: _Block) -> Iterator[pa.RecordBatch]:
        for lang, shard, words, sequence in block.joined():
            known, place = np.array(words.hashes, np.uint64), np.array([words.seed ^ shard], np.uint64).view(np.int64)[0]
            for size, starts, count in _parts(sequence, longest):
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(sequence, starts, size, known).view(np.int64)), pa.array(np.full(len(starts), place, np.int64)), pa.array(count)], schema=layout)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, frequent.value, True):
            yield from rows(block)

    return texts.mapInArrow(work, "hash long, place long, n long")


def _counted(texts: DataFrame, frequent, candidates, longest: int) -> DataFrame:
    """``lang, phrase, n`` of every block: phrases that may be frequent in some shard."""
    layout = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def rows(block: _Block) -> Iterator[pa.RecordBatch]:
        for lang, _, words, sequence in block.joined():
            names, known = pa.array(words.names, pa.binary()), np.array(words.hashes, np.uint64)
            wanted = lambda at, size: candidates.value.holds(_hashes(sequence, at, size, known))  # noqa: E731, B023
            for size, starts, count in _parts(sequence, longest, wanted):
                phrase = pc.binary_join_element_wise(*[names.take(pa.array(sequence[starts + k])) for k in range(size)], pa.scalar(b" ", pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.DictionaryArray.from_arrays(np.zeros(len(starts), np.int8), [lang]).cast(pa.string()), phrase.cast(pa.string()), pa.array(count)], schema=layout)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, frequent.value, False):
            yield from rows(block)

    return texts.mapInArrow(work, "lang string, phrase string, n long")


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys together: they are counted per block already, so that counting them once more before they move gains nothing."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def frequent_phrases(docs: DataFrame, longest: int = 3, support: int = 10, shards: int = SHARDS, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Exact counts ``lang, phrase, size, a`` of all phrases of 1 to ``longest`` words that occur ``support`` times in their language, and ``lang, n``, the words of each."""
    spark, scratch, content = docs.sparkSession, Scratch(docs.sparkSession), whole(F.col(f"`{text}`"))
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        shard_of(docs, shards, content).alias("shard"), content.alias("text")).where("text != ''")
    counted = scratch.keep(_dealt(_word_counts(texts), "lang", "word").groupBy("lang", "shard", "word").agg(F.sum("n").alias("n")))
    totals = counted.where("word IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    words = counted.where(F.col("word").isNotNull() & (F.col("n") >= support))
    frequent = spark.sparkContext.broadcast(bit_map(words.select(F.xxhash64("lang", "word").alias("hash")), "hash"))

    # The support of a shard: ``support`` times its share of the language's words, rounded up; all in whole numbers.
    sizes = counted.where("word IS NULL").select("lang", F.col("shard").alias("of"), F.col("n").cast("decimal(19,0)").alias("held"))
    shares = sizes.join(totals.select(F.col("lang").alias("l"), F.col("n").cast("decimal(19,0)").alias("all")), F.col("lang") == F.col("l"))
    # A shard of a language by the hash of the language, as the tasks name it; two of one hash would only bring more candidates.
    least = shares.select(F.xxhash64("l").bitwiseXOR(F.col("of").cast("long")).alias("at"), F.expr(f"cast(greatest(1, (held * {support} + all - 1) div all) AS long)").alias("least"))
    local = _dealt(_mined(texts, frequent, longest), "hash").groupBy("hash", "place").agg(F.sum("n").alias("n"))
    # At most ``shards`` rows a language.
    often = local.join(F.broadcast(least), F.col("place") == F.col("at")).where("n >= least")
    candidates = spark.sparkContext.broadcast(bit_map(often, "hash"))

    exact = _dealt(_counted(texts, frequent, candidates, longest), "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= support)
    exact = exact.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), "a")
    single = words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("a"))
    return scratch.keep(exact.unionByName(single)), scratch.keep(totals)


def _key(lang: Column, phrase: Column) -> Column:
    return F.concat_ws("\n", lang, phrase)  # no word holds a line end


def _scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more with ``l``, ``r`` and ``score`` of their lowest cut."""
    words = F.split("phrase", " ")
    part = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cuts = (phrases.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "size", "a", "k", _key(F.col("lang"), part(F.lit(1), F.col("k"))).alias("before"),
                    _key(F.col("lang"), part(F.col("k") + 1, F.col("size") - F.col("k"))).alias("behind")))
    spread = F.concat_ws("\n", "lang", "phrase")
    hot = find_hot(cuts, ["before", "behind"])
    for side, name in (("before", "l"), ("behind", "r")):
        counts = phrases.select(_key(F.col("lang"), F.col("phrase")).alias(f"of_{side}"), F.col("a").alias(name))
        cuts = lookup(cuts.withColumn("spread", spread), counts, side, f"of_{side}", hot=hot[side], spread="spread").drop("spread", f"of_{side}")
    # Products of three counts may pass 64 bits, so they are decimals of up to 38 digits; the quotient is at most a million.
    exact = cuts.withColumn("score", F.expr("(cast(cast(a AS decimal(16,0)) * cast(a AS decimal(15,0)) * 1000000 AS decimal(38,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))"))
    lowest = exact.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def _longer(phrases: DataFrame, longest: int) -> DataFrame:
    """``lang, inner, most``: for each phrase that lies in longer frequent ones, the occurrences of the most frequent of these."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    return (phrases.where(F.col("size") > 2).select(F.col("lang").alias("of"), F.explode(F.array_distinct(inner)).alias("inner"), "a")
            .groupBy("of", "inner").agg(F.max("a").alias("most")))


def collocations(docs: DataFrame, longest: int = 3, support: int = 10, top: int = 2000, covered: int = 50, shards: int = SHARDS, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language of 2 to ``longest`` words that occur ``support`` times.

    ``score`` is a million times ``a * a / (l * r)``, rounded down, at the cut into a first and a second part (``l`` and ``r`` occurrences) where it is lowest, of equal
    ones the first. A phrase is left out if a longer one that holds it occurs at least ``covered`` per cent as often.
    """
    phrases, totals = frequent_phrases(docs, longest, support, shards, text, lang)
    longer = _longer(phrases, longest)
    kept = (_scored(phrases).join(longer, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("inner")), "left")
            .where(F.coalesce(100 * F.col("most") < covered * F.col("a"), F.lit(True))))
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # First the best of many parts of a language, then the best of these: no task ranks a whole language.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = totals.select(F.col("lang").alias("l_of"), "n")
    return ranked.join(sizes, F.col("lang") == F.col("l_of")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
