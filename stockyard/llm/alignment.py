"""Alignment of two tokenizers' tokens, with counts of linked pairs behind a minimal perfect hash.

A text is encoded by both vocabularies and each token covers a range of the text's bytes. Where a token of either ends at the same byte, the text is
cut into groups; an A token and a B token whose ranges end together are linked. The first pass over the corpus finds the links and
hands on each task's distinct pairs with their counts. The distinct pairs get a minimal perfect hash: a cascade of bit arrays in which a pair is placed at the first level where
it is alone at its position; its number is the rank of its bit. Each task's counts become a dense vector in the order of these numbers, cut into blocks, and the
vectors are summed up a tree, block by block. The second pass aligns every text again and looks up the counts of its links; a pair is compared with the key stored at its number.

No token of either vocabulary goes over a blank between two other characters, so both cut a text there and its groups are those of its chunks in a row. Chunks that a task
meets again are aligned once while they are remembered; texts for which this does not hold (blanks in a row, other white space beside one) are aligned whole.

Two tokens that end together cover the same last bytes, so one is the end of the other. The pairs for which that holds are a property of the two vocabularies
(``possible_pairs`` counts them, some hundred thousand) and bound the hash and its vectors, however large the corpus is; that is checked before they are sent to the executors.

Defined results: texts that are NULL or empty, or whose tokens of either kind do not spell a blank and the text, have no tokens, no groups and no links; special strings in a text are plain
text; repeated rows count as often as they occur; an empty table has no pairs; extra columns are not touched.
"""

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm.rows import whole
from stockyard.llm.scratch import Scratch

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
#: Counters of one block, vectors summed by one task of the tree, and bits a key of each level of the hash.
_BLOCK, _FAN, _GAMMA = 8192, 32, 2
#: Code points read together, and chunks remembered.
_SOME, _REMEMBERED = 4_000_000, 200_000
#: Chunks encoded as one text; the piece encoder slows down on long ones.
_ROW = 200
#: A blank beside other white space or at an end of the text.
_LOOSE = re.compile(r" \s|\s |\A\s|\s\Z")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Numbers ``0`` to ``n - 1`` for ``n`` distinct keys; other keys get a number too, so the stored key decides."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        self.levels, self.ranks, before, left = [], [], 0, keys
        while len(left):
            at = self._place(left, len(self.levels), _GAMMA * len(left))
            alone = np.bincount(at, minlength=_GAMMA * len(left)) == 1
            self.levels.append(alone)
            self.ranks.append(before + np.cumsum(alone) - alone)
            before += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros(len(keys), np.uint64)
        self.keys[self._numbers(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.full(1, level + 1, np.uint64) * _GOLDEN
        return ((_mixed(keys * _GOLDEN + seed) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)

    def _numbers(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.levels, self.ranks)):
            at = self._place(keys[left], level, len(alone))
            here = alone[at]
            out[left[here]] = rank[at[here]]
            left = left[~here]
        return out

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that are not in the set."""
        keys = np.asarray(keys, np.uint64)
        numbers = self._numbers(keys)
        if len(self.keys):
            numbers[self.keys[numbers] != keys] = -1
        return numbers


def _path(name: str, path: str | None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(name)


class Vocabularies:
    """Both encoders, and the bytes of each of their tokens."""

    #: Fixed value: the pattern by which byte-level vocabularies of this kind split a text before merging.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, a: str | None = None, b: str | None = None):
        import sentencepiece
        import tiktoken
        with open(_path("byte_bpe_50k.json", a), encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"] for t in described["added_tokens"]}
        letters = self._letters()
        tokens = {bytes(letters[c] for c in t): i for t, i in described["model"]["vocab"].items() if t not in special}
        # Merges are numbered in the order in which they apply, as the library does; the tests compare both on every code point.
        self.first = tiktoken.Encoding("byte_bpe", pat_str=self.PATTERN, mergeable_ranks=tokens, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=_path("piece_bpe_32k.model", b))
        self.a = [b""] * (max(tokens.values()) + 1)
        for t, i in tokens.items():
            self.a[i] = t
        self.b = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.lengths = tuple(np.array([len(t) for t in side], np.int64) for side in (self.a, self.b))
        self.names = tuple([str(i) for i in range(len(side))] for side in (self.a, self.b))
        # Chunks are aligned by themselves if every byte has a token and no piece has a blank behind another character.
        bytes_there = sum(map(self.second.is_byte, range(len(self.b)))) == 256
        self.by_chunk = bytes_there and not any("▁" in self.second.id_to_piece(i).lstrip("▁") for i in range(len(self.b)))

    @staticmethod
    def _letters() -> dict[str, int]:
        """The byte for which each letter of the byte-level vocabulary stands: printable bytes stand for themselves, others follow from 256 on."""
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        other = iter(range(256, 512))
        return {chr(b if b in plain else next(other)): b for b in range(256)}

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(re.fullmatch(r"<0x(..)>", piece)[1], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Both id sequences of each text, ``None`` for a text without tokens."""
        there = [t for t in texts if t]
        pairs = iter(zip(there, self.first.encode_ordinary_batch([f" {t}" for t in there], num_threads=1), self.second.encode(there, num_threads=1)))
        for text in texts:
            if not text:
                yield None
                continue
            _, a, b = next(pairs)
            spelled = f" {text}".encode("utf-8", "surrogatepass")
            same = b"".join(map(self.a.__getitem__, a)) == spelled and b"".join(map(self.b.__getitem__, b)) == spelled
            yield (np.array(a, np.int64), np.array(b, np.int64)) if same else None

    def chunks(self, text: str) -> list[str] | None:
        """What stands between the blanks of a text, ``None`` if the text has to be aligned whole."""
        if self.by_chunk and not _LOOSE.search(text) and self.second.normalize(text).replace("▁", " ") == f" {text}":
            return text.split(" ")
        return None

    def together(self, chunks: list[str]) -> Iterator[tuple[list[str], tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]]:
        """Some chunks at a time, in a row as one text: its ids, its cuts, and for each chunk where its groups end."""
        for some, _ in _runs(chunks, chunks):
            rows = list(self.encode([" ".join(some[lo:lo + _ROW]) for lo in range(0, len(some), _ROW)]))
            if any(row is None for row in rows):
                raise ValueError("chunks that spell themselves do not do so in a row")
            ids = tuple(np.concatenate(side) for side in zip(*rows))
            at = self.cuts(*ids)
            ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) + 1 for c in some])
            yield some, ids, at, np.searchsorted(np.cumsum(self.lengths[0][ids[0]])[at[0]], ends) + 1

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in either sequence of the tokens that end where one of the other ends, in order; no token is empty, so places pair up one to one."""
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        at = np.zeros(int(ends_a[-1]) + 1, bool)
        at[ends_b] = True
        common = at[ends_a]
        at[:] = False
        at[ends_a] = True
        return np.flatnonzero(common), np.flatnonzero(at[ends_b])

    def possible_pairs(self) -> int:
        """Pairs of tokens of which one is the end of the other: no other pair can be linked."""
        ends = {False: {}, True: {}}
        for side, tokens in ((False, self.a), (True, self.b)):
            for t in tokens:
                ends[side][t] = ends[side].get(t, 0) + (t != b"")
        longer_a = sum(ends[True].get(t[k:], 0) for t in self.a for k in range(len(t)))
        longer_b = sum(ends[False].get(t[k:], 0) for t in self.b for k in range(1, len(t)))
        return longer_a + longer_b


_loaded: dict = {}


def vocabularies(a: str | None, b: str | None) -> Vocabularies:
    """Once per worker."""
    if (a, b) not in _loaded:
        _loaded[a, b] = Vocabularies(a, b)
    return _loaded[a, b]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)


def _runs(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """Runs of whole texts of about ``_SOME`` code points, or one longer text."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if k > lo and size + len(t) > _SOME:
            yield ids[lo:k], texts[lo:k]
            lo, size = k, 0
        size += len(t)
    if lo < len(texts):
        yield ids[lo:], texts[lo:]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            rows = batch.slice(lo, 512)
            yield from _runs(rows.column(0).to_pylist(), rows.column(1).to_pylist())


def _task_pairs(texts: DataFrame, a: str | None, b: str | None) -> DataFrame:
    """``task, key, n``: the distinct linked pairs of each task with their counts."""
    layout = pa.schema([("task", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, found, seen = vocabularies(a, b), [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], Counter()

        def settle():
            """Chunks and pairs counted so far become distinct pairs."""
            for some, ids, at, ends in both.together(list(seen)):
                times = np.fromiter(map(seen.__getitem__, some), np.int64, len(some))
                found.append((_pair(ids[0][at[0]], ids[1][at[1]]), np.repeat(times, np.diff(ends, prepend=0))))
            seen.clear()
            distinct, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, place, np.concatenate([n for _, n in found]))
            found[:] = [(distinct, total)]

        for _, some in _read(batches):
            unlike = []
            for text in some:
                parts = both.chunks(text) if text else None
                if parts is None:
                    unlike.append(text)
                else:
                    seen.update(parts)
            for ids in both.encode(unlike):
                if ids is not None:
                    at = both.cuts(*ids)
                    found.append((_pair(ids[0][at[0]], ids[1][at[1]]), np.ones(len(at[0]), np.int64)))
            if len(seen) > _REMEMBERED or len(found) > 1000:
                settle()
        settle()
        distinct, total = found[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), TaskContext.get().partitionId(), np.int64)), pa.array(distinct.view(np.int64)), pa.array(total)], schema=layout)

    return texts.select(F.lit(0).alias("id"), "text").mapInArrow(work, "task long, key long, n long")


def _tree_summed(pairs: DataFrame, numbers, rows: int, scratch: Scratch) -> np.ndarray:
    """The dense count vector of all tasks: a vector a task, in blocks, summed ``_FAN`` at a time until one is left."""
    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            task, key, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            number = numbers.value(key.view(np.uint64))
            if (number < 0).any():
                raise ValueError("a pair is not in the hash that was made of all pairs")
            for one in np.unique(task):
                blocks, mine = vectors.setdefault(int(one), {}), task == one
                for block in np.unique(number[mine] // _BLOCK):
                    here = mine & (number // _BLOCK == block)
                    np.add.at(blocks.setdefault(int(block), np.zeros(_BLOCK, np.int64)), number[here] % _BLOCK, n[here])
        rows = [(task, block, counts.tobytes()) for task, blocks in vectors.items() for block, counts in blocks.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["task", "block", "counts"])

    def added(vectors: pa.Table) -> pa.Table:
        total = np.zeros(_BLOCK, np.int64)
        for counts in vectors.column("counts").to_pylist():
            total += np.frombuffer(counts, np.int64)
        return pa.table({"task": [vectors.column("task")[0].as_py() // _FAN], "block": [vectors.column("block")[0].as_py()], "counts": pa.array([total.tobytes()], pa.binary())})

    now = scratch.keep(pairs.mapInArrow(dense, "task long, block long, counts binary"))
    while True:
        last = now.agg(F.max("task")).first()[0]
        step = scratch.keep(now.groupBy("block", F.floor(F.col("task") / _FAN).alias("branch")).applyInArrow(added, "task long, block long, counts binary"))
        scratch.drop(now)
        now = step
        if not last or last < _FAN:
            break
    out = np.zeros((rows + _BLOCK - 1) // _BLOCK * _BLOCK, np.int64)
    for r in now.select("block", "counts").collect():  # one vector, bounded by the vocabularies
        out[r.block * _BLOCK:(r.block + 1) * _BLOCK] = np.frombuffer(r.counts, np.int64)
    scratch.drop(now)
    return out[:rows]


class PairCounts:
    """How many links of the corpus hold each pair, and whether that is the highest of its B id."""

    def __init__(self, numbers: PerfectHash, counts: np.ndarray):
        self.numbers, self.counts = numbers, counts
        b = (numbers.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        highest = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
        np.maximum.at(highest, b, counts)
        self.best = counts == highest[b] if len(b) else np.zeros(0, bool)

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair, and whether it is its B id's best. All pairs are known."""
        at = self.numbers(_pair(a, b))
        if (at < 0).any():
            raise ValueError("a pair is not in the hash that was made of all pairs")
        return self.counts[at], self.best[at]

    def table(self, spark: SparkSession) -> DataFrame:
        """``a, b, links, best``: every pair of the corpus."""
        keys = self.numbers.keys
        rows = zip((keys >> np.uint64(32)).tolist(), (keys & np.uint64(0xFFFFFFFF)).tolist(), self.counts.tolist(), self.best.tolist())
        return spark.createDataFrame(list(rows), "a long, b long, links long, best boolean")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole(F.col(f"`{text}`")).alias("text"))


def pair_counts(docs: DataFrame, text: str = "text", a: str | None = None, b: str | None = None) -> PairCounts:
    """First pass: the counts of all linked pairs of the corpus."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    pairs = scratch.keep(_task_pairs(docs.select(whole(F.col(f"`{text}`")).alias("text")), a, b))
    distinct = pairs.select("key").distinct()
    rows, most = distinct.count(), vocabularies(a, b).possible_pairs()
    if rows > most:
        raise ValueError(f"{rows} linked pairs where the vocabularies allow {most}")
    numbers = PerfectHash(np.sort(distinct.toPandas()["key"].to_numpy(np.int64).view(np.uint64)))
    counts = _tree_summed(pairs, spark.sparkContext.broadcast(numbers), rows, scratch)
    scratch.drop(pairs)
    return PairCounts(numbers, counts)


def groups(names: tuple[list[str], list[str]], a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[str]:
    """``a1,a2|b1`` of each group."""
    first, second = [names[0][i] for i in a.tolist()], [names[1][i] for i in b.tolist()]
    ends_a, ends_b = [0, *(at_a + 1).tolist()], [0, *(at_b + 1).tolist()]
    return [f"{first[i]}|{second[k]}" if j == i + 1 and m == k + 1 else f"{','.join(first[i:j])}|{','.join(second[k:m])}"
            for (i, j), (k, m) in zip(pairwise(ends_a), pairwise(ends_b))]


class _Chunks:
    """What the chunks of a worker's texts add to a text: tokens of either kind, groups, best links, sum of counts, and the groups as text."""

    def __init__(self, both: Vocabularies, counts: PairCounts):
        self.both, self.counts = both, counts
        self.place, self.texts, self.numbers = {}, [], np.zeros((0, 5), np.int64)

    def learn(self, chunks: set[str]) -> None:
        if len(self.place) + len(chunks) > 2 * _REMEMBERED:
            self.place, self.texts, self.numbers = {}, [], np.zeros((0, 5), np.int64)
        for some, ids, at, ends in self.both.together(list(chunks - self.place.keys())):
            count, best = self.counts.of(ids[0][at[0]], ids[1][at[1]])
            spelled, stops = groups(self.both.names, *ids, *at), [0, *ends.tolist()]
            upto = [np.concatenate([[0], x]) for x in (at[0] + 1, at[1] + 1, np.arange(1, len(count) + 1), np.cumsum(best), np.cumsum(count))]
            self.place.update(zip(some, range(len(self.texts), len(self.texts) + len(some))))
            self.texts += [";".join(spelled[i:j]) for i, j in pairwise(stops)]
            self.numbers = np.concatenate([self.numbers, np.stack([np.diff(x[stops]) for x in upto], 1)])

    def of(self, parts: list[str]) -> tuple[list[int], str]:
        at = list(map(self.place.__getitem__, parts))
        return self.numbers[at].sum(0).tolist(), ";".join([self.texts[i] for i in at])


def aligned(docs: DataFrame, counts: PairCounts, doc_id: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None, with_groups: bool = True) -> DataFrame:
    """Second pass, one row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` and, if wanted, ``groups`` as text.

    ``n_best`` counts the links whose pair is the corpus's most frequent of its B id, ``count_sum`` adds up the counts of all links.
    """
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    fields = [("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())]
    fields += [("groups", pa.string())] if with_groups else []
    layout = pa.schema(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, known = vocabularies(a, b), _Chunks(vocabularies(a, b), sent.value)
        for ids, some in _read(batches):
            split = [both.chunks(t) if t else None for t in some]
            known.learn(set().union(*[s for s in split if s]))
            whole_texts = both.encode([t if s is None else "" for s, t in zip(split, some)])
            rows = []
            for one, parts, coded in zip(ids, split, whole_texts):
                if parts is not None:
                    numbers, spelled = known.of(parts)
                elif coded is not None:
                    at = both.cuts(*coded)
                    count, best = sent.value.of(coded[0][at[0]], coded[1][at[1]])
                    numbers, spelled = (len(coded[0]), len(coded[1]), len(at[0]), int(best.sum()), int(count.sum())), ";".join(groups(both.names, *coded, *at))
                else:
                    numbers, spelled = (0, 0, 0, 0, 0), ""
                n_a, n_b, n_groups, n_best, count_sum = numbers
                # A group's last tokens are its link: no token is empty, so no other two end there.
                rows.append((one, n_a, n_b, n_groups, n_groups, n_best, count_sum, hashlib.sha256(spelled.encode()).hexdigest() if spelled else "", spelled))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(layout)], schema=layout)

    kinds = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in layout)
    return _texts(docs, doc_id, text).mapInArrow(work, kinds)
