"""Operators against plain versions that follow the definitions step by step."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.llm import fingerprint, html_text, language_id, queries, secrets


# --- closed syncmers -----------------------------------------------------------------------

def _hash(text: str) -> int:
    """The hash of one run of characters, from the module, so that only the choice of anchors is under test."""
    codes = fingerprint._mixed(np.array([ord(c) for c in text], np.uint64) + fingerprint._MULTIPLY)
    return int(fingerprint._grams(codes, len(text))[0])


def plain_anchors(text: str, k: int = fingerprint.K, s: int = fingerprint.S) -> list[tuple[int, int]]:
    found = []
    for i in range(len(text) - k + 1):
        inner = [_hash(text[j:j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i, _hash(text[i:i + k])))
    return found or ([(0, _hash(text))] if text else [])


@pytest.mark.parametrize("n", [0, 1, 7, 15, 16, 17, 23, 24, 47, 48, 49, 300])
def test_anchors_equal_plain_closed_syncmers(n):
    rng = random.Random(n)
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz ", "\U0001F600é a"):
        text = "".join(rng.choice(letters) for _ in range(n))
        at, hashes = fingerprint.syncmers(text)
        assert list(zip(at.tolist(), hashes.tolist())) == plain_anchors(text)


@pytest.mark.parametrize("n", [30, 46, 47, 48, 60])
def test_a_short_passage_shares_its_anchors_with_a_text_that_holds_it(n):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    around = ["".join(rng.choice("qrstuvwxyz ") for _ in range(200)) for _ in range(2)]
    _, own = fingerprint.syncmers(passage)
    _, within = fingerprint.syncmers(around[0] + passage + around[1])
    assert len(own) and set(own.tolist()) <= set(within.tolist())


def test_op2_equals_plain_version(spark, tmp_path):
    rng = random.Random(11)
    texts = [None, "", "a", "short text", "x" * 15, "y" * 16, "same words again", "same words again"]
    texts += [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "épsilon"]) + str(rng.randint(0, 50)) for _ in range(n)) for n in (3, 9, 40, 400, 900)]
    rows = [(i * 3 + 1, t, "en", "web", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.queries()["op2_fingerprints"](spark, str(tmp_path)).collect()}
    order = sorted(((i, t or "") for i, t, *_ in rows), reverse=True)
    assert len(got) == len(rows)

    def sketch(text):
        return sorted({h >> 32 for _, h in plain_anchors(text)})[:fingerprint.SKETCH]

    def alike(one, other):
        if one == other:
            return 1.0
        both = sorted(set(one) | set(other))[:fingerprint.SKETCH]
        return len(set(one) & set(other) & set(both)) / len(both)

    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        row = got[doc_id]
        own, changed, next_one = sketch(text), sketch(edited), sketch(following)
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row.fingerprint == "".join(f"{h:08x}" for h in own) and row.edited_fingerprint == "".join(f"{h:08x}" for h in changed)
        assert (row.near_edited, row.near_next) == pytest.approx((alike(own, changed), alike(own, next_one)))


# --- entropy of windows ----------------------------------------------------------------------

def _plain_entropy(candidate: str) -> list[tuple[int, int]]:
    def blocked(s):
        return not any(c.isdigit() for c in s) or any(p.fullmatch(s) for p in secrets.ALLOWED)

    if blocked(candidate):
        return []
    marked, n = set(), secrets.WINDOW
    pieces = [(0, len(candidate))] + [m.span() for c in ("[0-9a-f]", "[0-9A-F]", "[0-9A-Za-z]") for m in re.finditer(c + "{%d,}" % n, candidate)]
    for lo, hi in pieces:
        piece = candidate[lo:hi]
        limit = next(bits for p, bits in secrets.CLASSES if p.fullmatch(piece))
        if blocked(piece) or limit == math.inf:
            continue
        for i in range(len(piece) - n + 1):
            window = piece[i:i + n]
            bits = -sum(window.count(c) / n * math.log2(window.count(c) / n) for c in set(window))
            if bits >= limit - 1e-9:
                marked.add((lo + i, lo + i + n))
    spans = []
    for a, b in sorted(marked):
        if spans and spans[-1][1] >= a:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def test_entropy_spans_equal_plain_windows():
    rng, found = random.Random(3), 0
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", "abcdefgh0123", "0123456789", "aaaa0", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcXYZ019+/=_-"]
    for _ in range(600):
        candidate = "".join("".join(rng.choice(rng.choice(alphabets)) if rng.random() < 0.05 else rng.choice(a) for _ in range(rng.randint(1, 45)))
                            for a in rng.choices(alphabets, k=rng.randint(1, 3)))
        if len(candidate) >= secrets.WINDOW:
            spans = secrets.entropy_spans(candidate)
            assert spans == _plain_entropy(candidate), candidate
            found += bool(spans)
    assert found > 50


# --- Kneser-Ney ----------------------------------------------------------------------------

def test_probabilities_sum_to_one_and_bits_equal_plain_kneser_ney(spark):
    texts = {"aa": ["banana bandana", "nab ban an", "ananas bana"], "bb": ["cold code", "doce old cod", "do cede deco"]}
    rows = [(lang, t) for lang, some in texts.items() for t in some]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string")).sent
    scorer = language_id.Scorer(model)
    for lang, some in texts.items():
        plain = _PlainKneserNey([w for t in some for w in language_id.words(t)], model["uniform"])
        column = model["langs"].index(lang)
        for history in (" ", " b", " ba", "ban", "ana", " c", " co", "cod", "old"):
            # Letters seen in any language, a blank and nothing else share the whole probability, but for what the uniform part gives to letters of no model.
            assert plain.total(history, model["uniform"]) == pytest.approx(1.0, abs=1e-9)
        for word in ("banana", "an", "zzz", "code", "old", "x", "nabcod"):
            assert scorer._word_bits([word])[0][0, column] == pytest.approx(plain.bits(word), rel=1e-4), (lang, word)


class _PlainKneserNey:
    """Order four with one discount a level; counts below the top are those of different left neighbours, raw at a word's start."""

    def __init__(self, words, uniform):
        self.uniform, self.counts = uniform, {4: {}, 3: {}, 2: {}, 1: {}}
        raw = {n: {} for n in (2, 3, 4)}
        for word in words:
            marked = f" {word} "
            for n in (2, 3, 4):
                for i in range(len(marked) - n + 1):
                    if n == 4 or i == 0:
                        raw[n][marked[i:i + n]] = raw[n].get(marked[i:i + n], 0) + 1
        self.counts[4] = raw[4]
        for n in (3, 2, 1):
            for gram in self.counts[n + 1]:
                self.counts[n][gram[1:]] = self.counts[n].get(gram[1:], 0) + 1
            for gram, c in raw.get(n, {}).items():
                self.counts[n][gram] = self.counts[n].get(gram, 0) + c
        self.cut = {}
        for n, counts in self.counts.items():
            ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
            self.cut[n] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(self, history, letter):
        n = len(history) + 1
        lower = self.uniform if n == 1 else self.p(history[1:], letter)
        after = {g: c for g, c in self.counts[n].items() if g[:-1] == history}
        if not after:
            return lower
        total = sum(after.values())
        return max(after.get(history + letter, 0) - self.cut[n], 0) / total + self.cut[n] * len(after) / total * lower

    def total(self, history, uniform):
        letters = [g for g in self.counts[1]]
        unseen = round(1 / uniform) - len(letters)
        return sum(self.p(history, c) for c in letters) + unseen * self.p(history, "\0")

    def bits(self, word):
        marked = f" {word} "
        return sum(-math.log2(self.p(marked[max(0, i - 3):i], marked[i])) for i in range(1, len(marked)))


# --- best region ----------------------------------------------------------------------------

def test_main_text_is_the_best_of_all_regions():
    rng = random.Random(9)
    weights = {"p": 0.25, "b": 0.125, "div": 2.0, "td": 1.5, html_text.OTHER: 2.5}  # exact in binary, so ties are ties
    for _ in range(300):
        page = "".join(rng.choice(["<p>", "</p>", "<div>", "</div>", "<td>", "<x-card>", "one two three ", "word ", "<nav>menu</nav>", "<b>", "a b c d e f "]) for _ in range(rng.randint(0, 14)))
        row = html_text.parts(page)
        worth = [len(v.split()) if k == html_text.WORD else -html_text.REMOVED if k == html_text.NOT else
                 -weights.get(v if v != "x-card" else html_text.OTHER, html_text.INSIDE if v in html_text._PLAIN else html_text.OUTSIDE) for k, v, _ in row]
        best = max(((sum(worth[i:j]), -j, i) for i in range(len(row)) for j in range(i + 1, len(row) + 1)), default=(0, 0, 0))
        said = " ".join(html_text.main_text(page, weights).split())
        want = " ".join(" ".join(v for k, v, _ in row[best[2]:-best[1]] if k == html_text.WORD).split()) if best[0] > 0 else ""
        assert said.replace(" ", "") == want.replace(" ", ""), page


def test_tag_weights_count_every_tag_whatever_its_name(spark):
    long_name = "my-very-long-custom-element-name"
    page = f"<html><body><div>menu</div><article><p>text</p><{long_name}>in</{long_name}></article>" + "".join(f"<x{k}>out</x{k}>" for k in range(1500)) + "</body></html>"
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    counts = {r.tag: (r.inside, r.outside) for r in html_text.tag_counts(pages).collect()}
    assert counts[html_text.OTHER] == (2, 3000) and counts["p"] == (2, 0) and counts["div"] == (0, 2)
    weights = html_text.tag_weights(pages)
    assert weights[html_text.OTHER] == pytest.approx(html_text.INSIDE + (html_text.OUTSIDE - html_text.INSIDE) * 3000 / 3002)
    assert pages.select(html_text.main_texts(F.col("html"), weights).alias("t")).first().t is not None


# --- held-out accuracy ----------------------------------------------------------------------

def test_op8_is_right_on_held_out_documents_and_its_scores_are_calibrated(spark):
    rows = queries.queries()["op8_language_id"](spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    held = rows.where("held_out").join(lang, "doc_id").where("truth is not null and lang_pred <> 'und'").select("score", (F.col("truth") == F.col("lang_pred")).alias("right")).collect()
    assert len(held) > 100 and sum(r.right for r in held) / len(held) >= 0.97
    for low in (0.25, 0.5, 0.75, 0.9):
        some = [r for r in held if low <= r.score <= min(low + 0.25, 1.0)]
        if len(some) >= 20:
            assert sum(r.right for r in some) / len(some) >= sum(r.score for r in some) / len(some) - 0.1
