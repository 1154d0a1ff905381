"""Shards against plain differencing, on rows with every awkward case."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stockyard.llm import queries, sharding
from stockyard.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"


def plain_spread(sizes, parts):
    """Differencing on sorted lists of all partial partitions, without a heap or labels."""
    tuples = [[s] + [0] * (parts - 1) for s in sizes]
    made = list(range(len(tuples)))
    while len(tuples) > 1:
        order = sorted(range(len(tuples)), key=lambda i: (tuples[i][-1] - tuples[i][0], made[i]))
        a, b = tuples[order[0]], tuples[order[1]]
        joined = sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)
        tuples = [t for i, t in enumerate(tuples) if i not in order[:2]] + [joined]
        made = [m for i, m in enumerate(made) if i not in order[:2]] + [max(made) + 1]
    return tuples[0] if tuples else [0] * parts


@pytest.mark.parametrize("parts", [2, 3, 8])
@pytest.mark.parametrize("seed", range(6))
def test_differencing_is_that_of_the_definition(parts, seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 10 ** rng.randint(1, 6)) for _ in range(rng.choice([0, 1, 2, 7, 60]))), reverse=True)
    dealt = sharding.differencing(sizes, parts)
    held = [0] * parts
    for size, part in zip(sizes, dealt):
        held[part] += size
    assert sorted(held, reverse=True) == plain_spread(sizes, parts)


def test_differencing_beats_greedy_dealing():
    rng = random.Random(3)
    sizes = sorted((rng.randint(1, 10**6) for _ in range(400)), reverse=True)
    held, greedy = [0] * 8, [0] * 8
    for size, part in zip(sizes, sharding.differencing(sizes, 8)):
        held[part] += size
        greedy[greedy.index(min(greedy))] += size
    assert max(held) - min(held) < max(greedy) - min(greedy)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rng = random.Random(9)
    texts = [None, "", "", "é" * 7, "x" * 4000, "hot"] + ["hot"] * 150 + ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 90))) for _ in range(500)]
    rows = [(None if i % 50 == 7 else i // 2, t, i, "s", 5) for i, t in enumerate(texts)] + [(3, "same", 0, "s", 5)] * 3
    path = str(tmp_path_factory.mktemp("shards") / "d")
    spark.createDataFrame(rows, "doc_id long, text string, shard int, slot string, `__row` int").repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def check(rows, shards):
    slots, of = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        of[r.text_crc32, r["size"]].add(r.shard)
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())  # equal texts, equal shard
    held = Counter()
    for r in rows:
        held[r.shard] += r["size"]
    return [held[s] for s in range(shards)]


def test_shards(docs):
    plain = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    got = sharding.shard_rows(docs, 3).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len(t) + 1, zlib.crc32(t)) for d, t in plain)
    groups = Counter()
    for _, t in plain:
        groups[t] += len(t) + 1
    assert sorted(check(got, 3), reverse=True)[0] - sorted(check(got, 3))[0] == plain_spread(sorted(groups.values(), reverse=True), 3)[0] - plain_spread(sorted(groups.values(), reverse=True), 3)[-1]
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, sharding.shard_rows(docs, 3).collect()), key=repr)  # a rerun agrees


def test_levels_stay_even(docs, spark):
    groups = docs.groupBy("text").agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("weight"))
    dealt = sharding.balanced(groups.select(F.xxhash64("text").alias("id"), "weight"), ["id"], 3, Scratch(spark), width=24, fan=48).collect()
    held = Counter()
    for r in dealt:
        held[r.part] += r.weight
    assert len(dealt) == groups.count() and max(held.values()) - min(held.values()) <= 0.02 * sum(held.values())


def test_empty_and_single(docs):
    assert sharding.shard_rows(docs.where("false")).count() == 0
    one = sharding.shard_rows(docs.where("text = 'same'"), 8).collect()
    assert len(one) == 3 and len({r.shard for r in one}) == 1 and sorted(r.slot for r in one) == [0, 1, 2]


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.where("text = 'hot'").select("_shard").distinct().count() == 1
    assert set(docs.columns) < set(back.columns)


def test_query(spark):
    got = queries.op11_shards(spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    held = check(rows, 8)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs) and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert {(r.doc_id, r["size"]) for r in rows} == {(d.doc_id, len((d.text or "").encode()) + 1) for d in docs}
    assert max(held) - min(held) <= 0.001 * sum(held)
