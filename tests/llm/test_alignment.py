"""Alignment against token ends compared pair by pair, with the libraries that the vocabularies are made for."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.llm import alignment as al
from stockyard.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def odd_texts():
    rng = random.Random(8)
    out = [None, "", " ", "   a  b ", "<|endoftext|> x <s> </s> <unk>", "▁ under", "ﬁ é Ａ　\x00\t\n x", "é 日本語 🙂👍🏽", "don't can't 'll", "\r\n\r\n\n  tabs\t\t", "\xa0a\xa0  "]
    out += ["x" * 5000, " " * 3000, "".join(chr(rng.choice([*range(32, 127), 0xE9, 0x4E2D, 0x1F600, 10, 0x0301])) for _ in range(2000))]
    return out + [" ".join(rng.choice(["the", "anblewh", "sttible,", "Zürich", "naïve.", "42", "(x)"]) for _ in range(rng.randint(1, 80))) for _ in range(30)]


def plain(rows, libraries):
    """Per row: token and group counts, all linked pairs, the groups as text."""
    first, second = libraries
    letters = al.Vocabularies._letters()
    found = []
    for text in rows:
        if not text:
            found.append(None)
            continue
        coded = first.encode(f" {text}", add_special_tokens=False)
        a = [(i, bytes(letters[c] for c in t)) for i, t in zip(coded.ids, coded.tokens)]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        spelled = f" {text}".encode()
        if b"".join(t for _, t in a) != spelled or b"".join(t for _, t in b) != spelled:
            found.append(None)
            continue
        ends = []
        for side in (a, b):
            at, out = 0, []
            for i, t in side:
                at += len(t)
                out.append((at, i))
            ends.append(out)
        both = {e for e, _ in ends[0]} & {e for e, _ in ends[1]}
        at_b = {}
        for e, j in ends[1]:
            at_b.setdefault(e, []).append(j)
        links = [(i, j) for e, i in ends[0] for j in at_b.get(e, ())]
        sides = []
        for side in ends:
            parts, now = [], []
            for e, i in side:
                now.append(str(i))
                if e in both:
                    parts.append(",".join(now))
                    now = []
            sides.append(parts)
        groups = [f"{x}|{y}" for x, y in zip(*sides, strict=True)]
        found.append((len(a), len(b), len(both), links, groups))
    count = Counter(x for f in found if f for x in f[3])
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        digest = hashlib.sha256(";".join(f[4]).encode()).hexdigest()
        out.append((*f[:3], len(f[3]), sum(count[x] == best[x[1]] for x in f[3]), sum(count[x] for x in f[3]), digest))
    return out, count


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_encoders_equal_their_libraries(libraries):
    both = al.vocabularies(None, None)
    texts = [t for t in odd_texts() if t] + [f" a{chr(c)}b {chr(c)}1 {chr(c)}\n{chr(c)}'s" for c in [*range(0x3000), *range(0x3000, 0xD800, 97), *range(0xE000, 0x110000, 997)]]
    for text, coded in zip(texts, both.encode(texts)):
        want = libraries[0].encode(f" {text}", add_special_tokens=False).ids, libraries[1].encode(text)
        assert coded is None or (coded[0].tolist(), coded[1].tolist()) == (want[0], want[1]), repr(text)
        assert both.first.encode_ordinary(f" {text}") == want[0]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(None if i == 20 else i, t, "x", 3) for i, t in enumerate(odd_texts())]
    path = str(tmp_path_factory.mktemp("aligned") / "d")
    spark.createDataFrame(rows + [rows[25]] * 4, "doc_id long, text string, `key` string, n_a int").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_alignment_equals_ends_compared_one_by_one(spark, docs, libraries):
    rows = docs.collect()
    want, count = plain([r.text for r in rows], libraries)
    counts = al.pair_counts(docs)
    assert {(r.a, r.b): r.links for r in counts.table(spark).collect()} == count
    got = al.aligned(docs, counts).collect()
    assert Counter((r.doc_id, *[r[c] for c in COLUMNS]) for r in got) == Counter((r.doc_id, *w) for r, w in zip(rows, want))
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got if r.groups)


def test_no_tokens(docs):
    for part in (docs.where("false"), docs.where("text IS NULL OR text = ''")):
        counts = al.pair_counts(part)
        rows = al.aligned(part, counts).collect()
        assert len(counts.counts) == 0 and all(r.n_a == 0 and r.groups_sha256 == "" for r in rows) and len(rows) == part.count()


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64))
    numbers = al.PerfectHash(keys)
    assert sorted(numbers(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(np.arange(5000, dtype=np.uint64), keys)
    assert (numbers(others) == -1).all()


def test_tree_of_vectors(spark, monkeypatch):
    """Many tasks and small blocks: three levels of sums."""
    from stockyard.llm.scratch import Scratch
    monkeypatch.setattr(al, "_BLOCK", 16)
    monkeypatch.setattr(al, "_FAN", 3)
    pairs = spark.range(0, 2000, 1, 20).selectExpr("id % 20 AS task", "id % 97 AS key", "id AS n")
    numbers = al.PerfectHash(np.arange(97, dtype=np.uint64))
    counts = al._tree_summed(pairs, spark.sparkContext.broadcast(numbers), 97, Scratch(spark))
    assert {int(k): int(counts[i]) for i, k in enumerate(numbers.keys)} == {r.key: r.n for r in pairs.groupBy("key").agg(F.sum("n").alias("n")).collect()}


def test_links_end_alike():
    both = al.vocabularies(None, None)
    texts = [t for t in odd_texts() if t]
    for coded in both.encode(texts):
        if coded is not None:
            at_a, at_b = both.cuts(*coded)
            assert len(at_a) == len(at_b)
            for i, j in zip(coded[0][at_a].tolist(), coded[1][at_b].tolist()):
                assert both.a[i].endswith(both.b[j]) or both.b[j].endswith(both.a[i])
    assert 300_000 < both.possible_pairs() < 400_000


def test_query_equals_a_plain_alignment(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want, _ = plain([d.text for d in docs], libraries)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op13_alignment(spark, SF).collect()}
    assert len(got) == len(docs)
    assert got == {d.doc_id: w for d, w in zip(docs, want)}
