"""Packing of documents into windows of bounded length, in order.

A dynamic programme over possible cuts (document ends, sentence ends and, in long stretches without either, places in between)
chooses the windows with the least sum of padding and truncation penalties. A window that ends at cut j and begins at cut i costs
``best(i) + at(i) + window - at(j) + penalty(j)``, so the best start is the least ``best(i) + at(i)`` among
the cuts at most a window back: a monotone queue gives it in constant time per cut.

Each partition of the input is packed by itself, in the order it is read, without a shuffle; tokens are held for one stretch of
documents at a time, and the last, unfinished windows of a stretch are planned again with the next one. What is left
at a partition's end goes into windows of a power of two where that costs less than padding.

Defined results: a NULL or empty text is one token, the end mark; repeated rows are documents of their own; extra columns are not touched;
an empty table gives no pieces. The input must be a plain reading of files, so that a task run anew packs the same.
"""

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.rows import whole
from stockyard.llm.tokens import byte_letters, load, plain_chunk

WINDOW, END_ID = 4096, 2
#: Costs in tokens of padding: a cut at a sentence end, a cut elsewhere. A cut between documents costs nothing.
SENTENCE_CUT, PLAIN_CUT = 2, 32
#: Where sentences are longer than this, places in between may be cut at, this far apart.
_STRETCH = 128
#: Tokens planned at once.
_PLANNED = 1 << 19
#: Chunks between blanks remembered by a worker, and the longest of them.
_REMEMBERED, _LONGEST = 300_000, 64


class Encoder:
    """Token ids as little-endian 32-bit bytes, through the library.

    The vocabulary drops white space and no token or normalisation reaches across it, so the ids of a text are those of its chunks
    between blanks in a row. Distinct chunks are encoded once while they are remembered. A plain chunk, letters and then marks, is
    split by rule and only its pieces go to the library's model; all others go through the whole library.
    """

    def __init__(self, path: str | None):
        self.tokenizer = load(path)
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.stops = np.zeros(max(vocabulary.values()) + 1, bool)
        self.stops[[i for t, i in vocabulary.items() if t.endswith("</w>") and t[:-4] and set(t[:-4]) <= set(".!?")]] = True

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            letters = piece if piece.isascii() else byte_letters(piece)
            tokens = self.tokenizer.model.tokenize(letters)
            known = self.pieces[piece] = tokens[0].id.to_bytes(4, "little") if len(tokens) == 1 else b"".join([t.id.to_bytes(4, "little") for t in tokens])
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        chunks = set().union(*split)
        known = self.known
        new = chunks - known.keys()
        if len(known) + len(new) > _REMEMBERED:
            known = self.known = {c: known[c] for c in chunks - new if len(c) <= _LONGEST}
            new = chunks - known.keys()
        if len(self.pieces) > _REMEMBERED:
            self.pieces = {}
        odd, piece = [], self._piece
        for chunk in new:
            simple = plain_chunk(chunk) if len(chunk) <= _LONGEST else None
            if simple:
                word, marks = simple.groups()
                known[chunk] = piece(word.lower()) + piece(marks) if marks else piece(word.lower())
            else:
                odd.append(chunk)
        for lo in range(0, len(odd), 4096):
            for chunk, coded in zip(odd[lo:lo + 4096], self.tokenizer.encode_batch_fast(odd[lo:lo + 4096], add_special_tokens=False)):
                known[chunk] = np.array(coded.ids, "<u4").tobytes()
        return [b"".join(map(known.__getitem__, s)) for s in split]


def cuts(ids: np.ndarray, ends: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, ascending, and their penalties. ``ends`` are the documents' ends."""
    inner = np.flatnonzero(stops[np.minimum(ids, len(stops) - 1)]) + 1
    at = np.union1d(inner, ends)
    gaps = np.diff(at, prepend=0)
    far = np.flatnonzero(gaps > _STRETCH)
    if len(far):
        more = [np.arange(at[k] - gaps[k] + _STRETCH // 2, at[k], _STRETCH // 2) for k in far]
        plain = np.concatenate(more)
        at = np.union1d(at, plain)
    penalty = np.full(len(at), SENTENCE_CUT, np.int64)
    if len(far):
        penalty[np.isin(at, plain)] = PLAIN_CUT
    penalty[np.isin(at, ends)] = 0
    return at, penalty


def plan(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> tuple[list[int], list[float]]:
    """For each cut the place among ``at`` where its window begins (-1: the beginning), and the least cost up to it."""
    back, cost = [], []
    queue = deque([(0, -1, 0)])  # (cost + position, cut, position), costs rising
    for j, (p, extra) in enumerate(zip(at.tolist(), penalty.tolist())):
        while queue[0][2] < p - window:
            queue.popleft()
        least, i, _ = queue[0]
        total = least + window - p + extra
        back.append(i)
        cost.append(total)
        rank = total + p
        while queue and queue[-1][0] >= rank:
            queue.pop()
        queue.append((rank, j, p))
    return back, cost


def windows(at: np.ndarray, back: list[int], last: int) -> list[int]:
    """Ends of the windows of the best plan that ends at cut ``last``."""
    out = []
    while last >= 0:
        out.append(int(at[last]))
        last = back[last]
    return out[::-1]


def tail(left: int, window: int = WINDOW) -> list[int]:
    """Lengths for the last tokens: powers of two while another cut is cheaper than padding."""
    out = []
    while left:
        whole_powers = bin(left).count("1")
        if left >= window:
            out.append(window)
        elif window - left <= (whole_powers - 1) * PLAIN_CUT:
            out.append(left)
        else:
            out.append(1 << (left.bit_length() - 1))
        left -= out[-1]
    return out


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ``ids`` are little-endian unsigned 32-bit integers.

    Every token of a document, its end mark included, is in exactly one piece. A sequence's pieces fill it from 0 without gaps;
    sequence numbers are unique over all partitions.
    """
    layout = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        end_mark = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        held: list = []  # [doc_id, bytes, tokens before]
        size = 0

        def emit(lengths: list[int]):
            """Pieces of the sequences of these lengths from the front of ``held``."""
            nonlocal sequence, held, size
            rows, room, k, used = [], 0, 0, 0
            for length in lengths:
                room = 0
                while room < length:
                    doc, data, before, total = held[k]
                    take = min(length - room, len(data) // 4 - used)
                    rows.append((doc, before + used, take, data[4 * used:4 * (used + take)], total, sequence, room))
                    room, used = room + take, used + take
                    if 4 * used == len(data):
                        k, used = k + 1, 0
                sequence += 1
                size -= length
                if len(rows) > 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), layout)], schema=layout)
                    rows = []
            held = held[k:]
            if used:
                doc, data, before, total = held[0]
                held[0] = (doc, data[4 * used:], before + used, total)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), layout)], schema=layout)

        def planned(last: bool):
            ids = np.frombuffer(b"".join(h[1] for h in held), "<u4")
            ends = np.cumsum([len(h[1]) // 4 for h in held])
            at, penalty = cuts(ids, ends, encoder.stops)
            back, cost = plan(at, penalty, window)
            near = np.flatnonzero(at > len(ids) - window)
            if last:
                # The best full windows, and for what remains after them padding or powers of two.
                def closing(j):
                    parts = tail(int(len(ids) - at[j]), window)
                    return cost[j] + PLAIN_CUT * max(0, len(parts) - 1) + sum(window - p for p in parts if p & (p - 1))
                begin = [(sum(window - p for p in tail(len(ids), window) if p & (p - 1)), -1)] if len(ids) <= window else []
                j = min(begin + [(closing(j), j) for j in near.tolist()])[1]
                stops = windows(at, back, j)
                rest = tail(len(ids) - (stops[-1] if stops else 0), window)
            else:
                j = min(near.tolist(), key=cost.__getitem__)
                stops, rest = windows(at, back, j), []
                stops = stops[:-2] if len(stops) > 2 else stops[:-1]  # planned again with what follows
            yield from emit([b - a for a, b in zip([0, *stops], stops)] + rest)

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                for doc, data in zip(ids, encoder.encode(texts)):
                    data += end_mark
                    held.append((doc, data, 0, len(data) // 4))
                    size += len(data) // 4
                if size >= _PLANNED:
                    yield from planned(False)
        if held:
            yield from planned(True)

    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole(F.col(f"`{text}`")).alias("text"))
    return picked.mapInArrow(work, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
