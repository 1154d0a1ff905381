"""Exact token counts of every prefix of a text, by dynamic programming.

A BPE encoding is the only sequence of tokens in which every neighbouring pair stays as it is when the two
are encoded together. So the encoding of each prefix ends in the one token that is compatible with the
encoding of what precedes it, and its count is one more than that prefix's: one pass over a word gives the counts of
all its prefixes. Words do not touch each other, hence a text's counts are its words' counts on top of each other.

The table of a text is one signed byte per code point, the change of the count there. Truncation and budget
questions are answered from it without encoding again.

Defined results: a NULL or empty text has an empty table; prefixes are those of the text's NFC form, which is the
text itself nearly always; extra columns are not touched.
"""

import json
import os
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Distinct words remembered by a worker before it starts afresh; longer words are not remembered.
_REMEMBERED, _LONGEST = 120_000, 64
#: Letters without any case or normalisation subtlety, then plain ASCII punctuation.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=>?@\[\]^_{|}~`\\]*)")


def vocabulary_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str | None):
    """The library's tokenizer, once per worker."""
    path = vocabulary_path(path)
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


_loaded: dict = {}
_tables: dict = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


_LETTERS = str.maketrans(dict(enumerate(_byte_letters())))


#: A chunk of letters and then marks, split by the vocabulary's rule without a doubt; ``None`` for other chunks.
plain_chunk = _SIMPLE.fullmatch


def byte_letters(piece: str) -> str:
    return piece.encode("utf-8").decode("latin-1").translate(_LETTERS)


class Remembered(dict):
    """A bounded memory: when it is full it starts anew, and takes over from the old one what is asked for again."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def make(self, key):
        return None

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if value is not None and len(key) <= _LONGEST:
            self[key] = value
        return value

    def __setitem__(self, key, value):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        super().__setitem__(key, value)


class PrefixCounts:
    """Prefix counts under a word-level BPE vocabulary with an end-of-word mark."""

    def __init__(self, path: str | None = None):
        self.tokenizer = load(path)
        with open(vocabulary_path(path), encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.end = model["end_of_word_suffix"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        closed = {t[: -len(self.end)] for t in model["vocab"] if t.endswith(self.end)}
        opened = {t for t in model["vocab"] if not t.endswith(self.end)}
        self.opened = {t for t in opened if len(self._merged(list(t))) == 1}
        self.closed = {t for t in closed if t and len(self._merged([*t[:-1], t[-1] + self.end])) == 1}
        self.longest = max(map(len, self.opened | self.closed))
        special = [t["content"] for t in described["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else re.compile("(?!)")
        self.contractions = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
        self.pairs = Remembered(4 * _REMEMBERED)
        self.prefixes = Remembered(2 * _REMEMBERED)
        self.runs = Remembered(_REMEMBERED)
        self.normal: dict = {}

    def _merged(self, parts: list[str]) -> list[str]:
        """BPE of a few symbols: the pair of lowest rank first, from the left."""
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get((parts[i], parts[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, left: str, right: str, ends: bool) -> bool:
        key = (left, right, ends)
        known = self.pairs[key]
        if known is None:
            right_symbols = [*right[:-1], right[-1] + self.end] if ends else list(right)
            parts = self._merged([*left, *right_symbols])
            known = self.pairs[key] = len(parts) == 2 and parts[0] == left
        return known

    def _state(self, word: str, j: int, before: list) -> tuple:
        """Of ``word[:j]``: its last token and count as an open prefix, and its count as a whole word. ``before`` has the shorter prefixes."""
        opened, closed, fits = self.opened, self.closed, self._fits
        last, count, whole = None, 0, 0
        for i in range(max(0, j - self.longest), j):
            token = word[i:j]
            if not whole and token in closed and (not i or fits(before[i][0], token, True)):
                whole = before[i][1] + 1
            if last is None and token in opened and (not i or fits(before[i][0], token, False)):
                last, count = token, before[i][1] + 1
            if whole and last is not None:
                break
        return last, count, whole

    def _word(self, word: str) -> list[int]:
        """Tokens of every prefix, as a word of its own, of one word in byte letters. States are remembered by prefix."""
        states, n = [("", 0, 0)], len(word)
        if n > _LONGEST:
            for j in range(1, n + 1):
                states.append(self._state(word, j, states))
        else:
            known = self.prefixes
            for j in range(1, n + 1):
                prefix = word[:j]
                state = known[prefix]
                if state is None:
                    state = known[prefix] = self._state(word, j, states)
                states.append(state)
        return [s[2] for s in states[1:]]

    def _letters(self, piece: str) -> list[int]:
        """Counts after each code point of one word in plain text, which is lower case already."""
        raw = piece.encode("utf-8")
        counts = self._word(byte_letters(piece))
        if len(raw) == len(piece):
            return counts
        end, out = 0, []
        for c in piece:
            end += len(c.encode("utf-8"))
            out.append(counts[end - 1])
        return out

    def marks(self, marks: str) -> bytes:
        """Changes of the count along one run of plain ASCII marks."""
        known = self.runs[marks]
        if known is None:
            known = self.runs[marks] = bytes(d & 255 for d in np.diff([0, *self._letters(marks)]).tolist())
        return known

    def _count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _ordinary(self, chunk: str) -> list[int]:
        """Counts after each code point of a chunk without special strings, through the library's own splitting."""
        lowered, owner = [], []
        for k, c in enumerate(chunk):
            low = self.normal.get(c)
            if low is None:
                low = self.normal[c] = self.tokenizer.normalizer.normalize_str(c)
            lowered.append(low)
            owner += [k] * len(low)
        out, base = [0] * len(chunk), 0
        text, done = "".join(lowered), 0
        for _, (start, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            piece = text[start:end]
            own = [self._count(piece[:i + 1]) for i in range(len(piece))] if piece in self.contractions else self._letters(piece)
            for k in range(done, owner[start]):
                out[k] = base
            for at, value in zip(range(start, end), own):
                out[owner[at]] = base + value
            done, base = owner[end - 1] + 1, base + own[-1]
        for k in range(done, len(chunk)):
            out[k] = base
        return out

    def counts(self, chunk: str) -> list[int]:
        """Counts after each code point of any text in NFC."""
        simple = plain_chunk(chunk)
        if simple:
            word, marks = simple.groups()
            out = self._letters(word.lower())
            return out + [out[-1] + c for c in self._letters(marks)] if marks else out
        out, base, done = [], 0, 0
        for match in self.special.finditer(chunk):
            before = chunk[done:match.start()]
            out += [base + c for c in self._ordinary(before)]
            whole = out[-1] if before else base
            # A special string that is cut short is ordinary text and may join what stands before it.
            out += [base + self._count(before + match.group()[:i]) for i in range(1, len(match.group()))]
            out.append(whole + 1)
            base, done = whole + 1, match.end()
        return out + [base + c for c in self._ordinary(chunk[done:])]


class _Words:
    """The same pass over many plain words at once, one position of all words after another."""

    _TIMES = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, model: PrefixCounts):
        self.model = model
        byte = {c: b for b, c in enumerate(_byte_letters())}
        self.names = sorted(model.opened | model.closed)
        keys = np.array([self._key(bytes(byte[c] for c in t)) for t in self.names], np.uint64)
        order = np.argsort(keys)
        self.keys, self.names = keys[order], [self.names[i] for i in order]
        self.opens = np.array([t in model.opened for t in self.names])
        self.closes = np.array([t in model.closed for t in self.names])
        self.powers = np.cumprod(np.full(model.longest + 1, self._TIMES, np.uint64))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True
        self.pairs, self.fit = np.zeros(1, np.int64) - 1, np.zeros(1, bool)
        self.fresh: dict[int, bool] = {}

    def _key(self, raw: bytes) -> int:
        h = 0
        for b in raw:
            h = (h * int(self._TIMES) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _fits(self, left: np.ndarray, right: np.ndarray, ends: int) -> np.ndarray:
        key = ((left.astype(np.int64) << 17) + right) * 2 + ends
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        out = self.fit[at]
        for k in np.flatnonzero(self.pairs[at] != key):
            pair = int(key[k])
            fits = self.fresh.get(pair)
            if fits is None:
                fits = self.fresh[pair] = self.model._fits(self.names[left[k]], self.names[right[k]], bool(ends))
            out[k] = fits
        return out

    def _settle(self) -> None:
        """Pairs met for the first time join the sorted ones."""
        if self.fresh:
            keys = np.concatenate([self.pairs, np.fromiter(self.fresh, np.int64, len(self.fresh))])
            fit = np.concatenate([self.fit, np.fromiter(self.fresh.values(), bool, len(self.fresh))])
            order = np.argsort(keys)
            self.pairs, self.fit, self.fresh = keys[order], fit[order], {}
        if len(self.pairs) > 16 * _REMEMBERED:
            self.pairs, self.fit = self.pairs[:1], self.fit[:1]

    def steps(self, words: list[str]) -> dict[str, bytes]:
        """Changes of the count at each code point of each word; words are distinct, lower case and not empty."""
        raw = sorted(((w.encode("utf-8"), w) for w in words), key=lambda x: -len(x[0]))
        sizes = np.array([len(r) for r, _ in raw])
        n, width = len(raw), int(sizes[0])
        there = np.arange(width) < sizes[:, None]
        letters = np.zeros((n, width + 1), np.uint8)
        letters[:, :width][there] = np.frombuffer(b"".join(r for r, _ in raw), np.uint8)
        counts = np.zeros((n, width), np.int16)
        hashes, last, count = [np.zeros(n, np.uint64)], [np.zeros(n, np.int32)], [np.zeros(n, np.int16)]
        for j in range(1, width + 1):
            m = int(np.searchsorted(-sizes, -j, "right"))
            hashes.append(hashes[-1][:m] * self._TIMES + letters[:m, j - 1] + np.uint64(1))
            token, tokens, whole = np.full(m, -1, np.int32), np.zeros(m, np.int16), np.zeros(m, np.int16)
            for i in range(max(0, j - self.model.longest), j):
                key = hashes[j] - hashes[i][:m] * self.powers[j - i - 1]
                rows = np.flatnonzero(self.maybe[key >> np.uint64(44)])
                at = np.minimum(np.searchsorted(self.keys, key[rows]), len(self.keys) - 1)
                found = self.keys[at] == key[rows]
                rows, at = rows[found], at[found]
                for ends, allowed in ((1, self.closes), (0, self.opens)):
                    wanted = allowed[at] & ((whole if ends else tokens)[rows] == 0)
                    r, t = rows[wanted], at[wanted]
                    if i and len(r):
                        fits = self._fits(last[i][r], t, ends)
                        r, t = r[fits], t[fits]
                    if ends:
                        whole[r] = count[i][r] + 1
                    else:
                        token[r], tokens[r] = t, count[i][r] + 1
            counts[:m, j - 1] = whole
            last.append(token)
            count.append(tokens)
        self._settle()
        ends = there & ((letters[:, 1:] & 0xC0) != 0x80)
        flat, per = counts[ends], ends.sum(1)
        stops = np.cumsum(per)
        starts = stops - per
        change = np.diff(flat, prepend=np.int16(0))
        change[starts] = flat[starts]
        if change.max() > 127 or change.min() < -128:
            raise ValueError("a count changes by more than a byte holds")
        table = change.astype(np.int8).tobytes()
        return {w: table[a:b] for (_, w), a, b in zip(raw, starts.tolist(), stops.tolist())}


class _Steps:
    """Changes of the count within each distinct chunk of text between blanks, one signed byte per code point."""

    def __init__(self, path: str | None):
        self.model = PrefixCounts(path)
        self.words = _Words(self.model)
        self.known: dict[str, bytes] = {}

    def _single(self, chunk: str) -> bytes:
        out, last = bytearray(), 0
        for count in self.model.counts(chunk):
            step = count - last
            if not -128 <= step <= 127:
                raise ValueError("a count changes by more than a byte holds")
            out.append(step & 255)
            last = count
        return bytes(out)

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Tables of the chunks and perhaps of others. Plain chunks are worked out together."""
        new = chunks - self.known.keys()
        if len(self.known) + len(new) > 2 * _REMEMBERED:
            self.known = {c: self.known[c] for c in chunks - new if len(c) <= _LONGEST}
            new = chunks - self.known.keys()
        plain, out = [], {}
        for chunk in new:
            simple = len(chunk) <= _LONGEST and plain_chunk(chunk)
            if simple:
                word, marks = simple.groups()
                plain.append((chunk, word.lower(), marks))
            else:
                out[chunk] = self._single(chunk)
        if plain:
            steps, runs = self.words.steps(list({w for _, w, _ in plain})), {m: self.model.marks(m) for m in {m for _, _, m in plain}}
            for chunk, word, marks in plain:
                out[chunk] = steps[word] + runs[marks]
        self.known.update(out)
        return self.known


def prefix_steps(texts: list[str], path: str | None = None) -> list[bytes]:
    """The table of each text: the change of its token count at each code point."""
    key = vocabulary_path(path)
    if key not in _tables:
        _tables[key] = _Steps(path)
    out = []
    for some in _batches(texts):
        split = [(t if t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t)).replace("\n", " ").split(" ") for t in some]
        tables = _tables[key].learn(set().union(*split))
        out += [b"\0".join(map(tables.__getitem__, chunks)) for chunks in split]
    return out


def _batches(texts: list[str], most: int = 3_000_000):
    """Runs of whole texts of about ``most`` code points, or one longer text."""
    some, size = [], 0
    for t in texts:
        if some and size + len(t) > most:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def prefix_counts(steps: bytes) -> np.ndarray:
    """Token count of every prefix, the empty one first."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def longest_prefix(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(prefix_counts(steps) <= budget)[-1])


def token_tables(text: Column, budgets: tuple[int, ...] = (), path: str | None = None) -> Column:
    """Struct of ``n_bytes``, ``n_tokens``, the table ``steps`` and ``fits``: for each budget the longest prefix within it.

    A Pandas UDF; texts are whole, one batch at a time.
    """
    @F.pandas_udf("n_bytes long, n_tokens long, steps binary, fits array<long>")
    def tables(texts: pd.Series) -> pd.DataFrame:
        steps = prefix_steps([t or "" for t in texts], path)
        totals = [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in steps]
        # A short text fits whole, as its count never falls to the budget from above; others ask the table.
        fits = [[len(s) if n <= b else longest_prefix(s, b) for b in budgets] for s, n in zip(steps, totals)]
        return pd.DataFrame({"n_bytes": [len((t or "").encode("utf-8", "surrogatepass")) for t in texts], "n_tokens": totals, "steps": steps, "fits": fits})

    return tables(text)
