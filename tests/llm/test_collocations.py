"""Phrases against a plain count of everything, and against SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.llm import collocations as co
from stockyard.llm import queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest, support, top, covered):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                count[lang or "und"].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        kept = []
        for p, a in often.items():
            if any(100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in often.items() if len(q) > len(p)):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts():
    rng = random.Random(4)
    words = ["The", "cat", "é", "日本", "a b", "x'y", "S", "s", "\x1c", "zz"]
    out = [None, "", " \t ", "?!.\n", "only"] + ["the cat sat, the cat sat. the cat"] * 12
    out += ["".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    return out + ["go on " * 4000]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(None if i == 3 else i, t, ("en", None, "de")[i % 3], "x", 1) for i, t in enumerate(texts())]
    path = str(tmp_path_factory.mktemp("phrases") / "d")
    spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, phrase string, `rank` int").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def both(docs, longest, support, top, covered, **how):
    got = sorted(map(tuple, co.collocations(docs, longest, support, top, covered, **how).collect()))
    return got, plain([(r.lang, r.text) for r in docs.collect()], longest, support, top, covered)


@pytest.mark.parametrize("longest,support,top,covered,shards", [(3, 10, 2000, 50, 4), (5, 3, 7, 90, 9)])
def test_phrases_equal_a_plain_count(docs, longest, support, top, covered, shards):
    got, want = both(docs, longest, support, top, covered, shards=shards)
    assert got == want and len(want) > 5


def test_small_blocks_and_slices(docs, monkeypatch):
    monkeypatch.setattr(co, "_SLICE", 64)
    rows = [(r.lang or "und", 0, r.text or "") for r in docs.collect()]
    whole_words = co._Block(None)
    for row in rows:
        whole_words.add(*row)
    monkeypatch.setattr(co, "_SLICE", 1 << 20)
    uncut = co._Block(None)
    for row in rows:
        uncut.add(*row)
    for (_, _, w, a), (_, _, v, b) in zip(whole_words.joined(), uncut.joined()):
        assert w.names == v.names and np.array_equal(a, b)


def test_a_full_bit_map_changes_nothing(docs, monkeypatch):
    """With 64 bits nearly every hash seems frequent: more is counted, the result is the same."""
    small = co.bit_map
    monkeypatch.setattr(co, "bit_map", lambda hashes, column: small(hashes, column, 6))
    got, want = both(docs, 3, 4, 100, 50)
    assert got == want


def test_no_phrases(docs):
    assert co.collocations(docs.where("false")).count() == 0
    assert co.collocations(docs.where("text IS NULL OR text = 'only'")).count() == 0


def test_counts_beyond_64_bits(spark):
    huge = 6_000_000_000
    rows = [("en", "a b", 2, huge), ("en", "a", 1, huge + 7), ("en", "b", 1, huge + 11)]
    got = co._scored(spark.createDataFrame(rows, "lang string, phrase string, size int, a long")).first()
    assert got.score == 1000000 * huge * huge // ((huge + 7) * (huge + 11))


def test_query_equals_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = queries.op12_collocations(spark, SF)
    cursor = con.execute(queries.OP12_SQL)
    assert [c[0] for c in cursor.description] == got.columns
    assert sorted(cursor.fetchall()) == sorted(map(tuple, got.collect()))
