"""Text operators against plain versions, on rows with every awkward case."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.llm import exact_dedup, fingerprint, html_text, language_id, mixing, near_dedup, packing, secrets, tokens, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, target string, rep long, `key` string"


def _texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ti", "on", "er", "th", "ing", "é", "ß"]) for _ in range(rng.randint(1, 4)))
    long_ = " ".join(word() for _ in range(4000)) + ". " + "x" * 9000
    base = " ".join(word() for _ in range(300))
    near = base.split()
    near[100] = "other"
    odd = ["", None, "   \n\t", "a", "That it.", "don't <|endoftext|> 'tis İΣς 日本 \x1c\xa0 e\u0301", "!!! ??? ...", "token: abcdefgh1234", "x" * 50]
    return odd + [long_, long_, base, base, base + " ", " ".join(near), base.upper()] + [" ".join(word() for _ in range(rng.randint(1, 60))) + "." for _ in range(30)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(None if i == 20 else i, t, ("en", "de", None)[i % 3], (None, "b", "a", "ä")[i % 4], 1, 2, "t", 3, "k") for i, t in enumerate(_texts())]
    rows += [rows[11], rows[11], rows[0]]  # repeated rows
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text or "", r.source, r.lang) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_mixing(docs, plain, empty):
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    run = lambda d: mixing.mix_rows(d, F.col("source"), size, F.col("doc_id"), keep=[F.col("doc_id")])
    got = run(docs).collect()
    sizes = defaultdict(int)
    for _, t, s, _ in plain:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped, level = set(), 0.0
    while True:
        free = [s for s in order if s not in capped]
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if 3 * sizes[s] <= level * weight[s]}
        if not over:
            break
        capped |= over
    assert {r.source: r.source_size for r in got} == dict(sizes)
    for r in got:
        assert r.target == pytest.approx(min(3 * sizes[r.source], level * weight[r.source])) and r.taken == r.copies * r["size"] and r.copies <= 3
    assert sum(r.taken for r in got) <= sum(sizes.values())
    assert sorted((str(r.doc_id), r.taken) for r in run(docs).collect()) == sorted((str(r.doc_id), r.taken) for r in got)
    mixed = mixing.mix(docs, F.col("source"), size, F.col("doc_id"))
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert run(empty).count() == 0


def test_mix_is_in_order_of_finish_times(docs, plain):
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = mixing.mix_rows(docs, F.col("source"), size, F.col("doc_id"), keep=[F.xxhash64(F.lit(1), "doc_id").alias("place"), F.col("doc_id")]).collect()
    upto, want = defaultdict(int), []
    for r in sorted(rows, key=lambda r: (r.place % 2**64, r["__row"])):
        upto[r.source] += r["size"]
        want += [((upto[r.source] + e * r.source_size) / r.target, r["__row"], e, r.doc_id) for e in range(r.copies)]
    got = [r.doc_id for r in mixing.mix(docs, F.col("source"), size, F.col("doc_id")).collect()]
    assert max(r.copies for r in rows) > 1 and got == [d for *_, d in sorted(want, key=lambda t: t[:3])]


@pytest.mark.parametrize("repeats", [10, 100, 600])
def test_fingerprint_of_a_repeated_passage(repeats):
    rng = random.Random(repeats)
    passage = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(1000))
    own = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(3000))
    for text in (passage * repeats, own + passage * repeats):
        want = sorted({int(h) >> 32 for h in fingerprint.syncmers(text)[1].tolist()})[:128]
        assert len(want) == 128 and fingerprint.fingerprint(text) == "".join(f"{h:08x}" for h in want)


@pytest.mark.parametrize("ids", [[*range(400), 10**12], [-2**63, 2**63 - 1, *range(10**15, 10**15 + 400)], [7] * 400])
def test_runs_of_neighbours_are_even_for_any_ids(spark, tmp_path, ids):
    from pyspark import TaskContext
    spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    judge = lambda rows: ({"doc_id": d, "a": t, "b": n, "task": TaskContext.get().partitionId()} for d, t, n in rows)
    read = spark.read.parquet(str(tmp_path / "d"))
    got = fingerprint.beside_next(read, judge, "doc_id long, a string, b string, task long").collect()
    # Rows of one id follow each other by file and place there.
    placed = read.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).collect()
    order = [r.text for r in sorted(placed, key=lambda r: (-r.doc_id, r.file, r.at))]
    assert {r.a: r.b for r in got} == dict(zip(order, order[1:] + order[:1])) and len(got) == len(ids)
    assert max(Counter(r.task for r in got).values()) < 0.9 * len(ids)


def test_fingerprints(docs, plain, empty):
    judge = lambda rows: ({"doc_id": d, "a": t, "b": n} for d, t, n in rows)
    got = [(r.doc_id, r.a, r.b) for r in fingerprint.beside_next(docs, judge, "doc_id long, a string, b string").collect()]
    assert Counter((d, t) for d, t, _ in got) == Counter((d, t) for d, t, _, _ in plain)
    ids = sorted((d for d, *_ in plain if d is not None), reverse=True)
    text = {d: t for d, t, *_ in plain}
    following = {a: b for a, b in zip(ids, ids[1:]) if a != b}
    assert all(n == text[following[d]] for d, _, n in got if d in following and ids.count(d) == 1)
    assert fingerprint.beside_next(empty, judge, "doc_id long, a string, b string").count() == 0
    long_ = text[9]
    at, hashes = fingerprint.syncmers(long_, 8, 4)
    seen = {}
    for p, h in zip(at.tolist(), hashes.tolist()):
        assert seen.setdefault(long_[p:p + 8], h) == h  # the same passage has the same anchor
    assert len(at) > len(" ".join(long_.split()[:100])) / 8
    f = fingerprint.fingerprint
    assert f("") == "" and fingerprint.likeness("", f(long_)) == 0 and fingerprint.likeness(f(long_), f(long_)) == 1
    assert fingerprint.likeness(f(long_), f(long_[:20000] + "zz" + long_[20000:])) > 0.8
    assert fingerprint.anchors(docs).count() == docs.count()


@pytest.mark.parametrize("hash_all", [True, False])
def test_exact_dedup(docs, plain, empty, hash_all):
    got = exact_dedup.duplicate_groups(docs, hash_all=hash_all).collect()
    groups = defaultdict(list)
    for d, t, *_ in plain:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), d is None, d if d is not None else 0))
    want = Counter((d, min(groups[k])[2], len(groups[k])) for d, t, *_ in plain for k in [re.sub(r"[\x20\x09-\x0D]", "", t)])
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got if r.doc_id is not None) == Counter({k: v for k, v in want.items() if k[0] is not None})
    assert sum(r.kept for r in got) == len(groups)
    assert {r.text_sha256 for r in got if r.text_sha256} <= {hashlib.sha256(k.encode()).hexdigest() for k in groups}
    assert exact_dedup.drop_duplicates(docs).columns == docs.columns and exact_dedup.drop_duplicates(docs).count() == len(groups)
    assert exact_dedup.duplicate_groups(empty).count() == 0


def test_drop_duplicates_hashes_only_what_survives(docs, monkeypatch):
    groups, seen = exact_dedup.duplicate_groups, []

    def watched(*args, **options):
        seen.append(groups(*args, **options))
        return seen[-1]

    monkeypatch.setattr(exact_dedup, "duplicate_groups", watched)
    exact_dedup.drop_duplicates(docs)
    alone, shared = (seen[0].where(c) for c in ("group_size = 1", "group_size > 1"))
    assert alone.where("text_sha256 is null").count() > 0 and shared.where("text_sha256 is null").count() == 0


def test_near_dedup(docs, plain, empty):
    got = near_dedup.near_classes(docs).collect()
    bags = []
    for _, t, *_ in plain:
        w = t.lower().split()
        bags.append(Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    name = list(range(len(bags)))
    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            shared = sum((a & b).values())
            if (not a and not b) or (a and b and shared >= 0.8 * (sum(a.values()) + sum(b.values()) - shared)):
                name = [name[j] if n == name[i] else n for n in name]
    classes = defaultdict(list)
    for n, (d, *_) in zip(name, plain):
        classes[n].append(d)
    assert Counter((r.doc_id, r.class_size) for r in got) == Counter((d, len(c)) for c in classes.values() for d in c)
    assert sum(r.kept for r in got) == len(classes)
    assert near_dedup.near_classes(empty).count() == 0


def test_bag_min_hash_estimates_weighted_jaccard():
    one, other = Counter({i: 1 + i % 7 for i in range(300)}), Counter({i: 1 + i % 5 for i in range(60, 360)})
    signed = []
    for bag in (one, other):
        run = near_dedup._mixed(np.array(sorted(bag), np.uint64) + np.uint64(99))
        signed.append(near_dedup.bag_min_hash(np.zeros(len(run), np.int64), run, np.array([bag[k] for k in sorted(bag)]), 1, 4000)[0])
    want = sum((one & other).values()) / sum((one | other).values())
    assert abs((signed[0] == signed[1]).mean() - want) < 0.04


@pytest.mark.parametrize("digits", ["0123456789abcdef", "0123456789ABCDEF"])
@pytest.mark.parametrize("prefix", ["key-", "api/", "SIG_", "sig=", "sk_live_", "x", "Z9+"])
def test_prefixed_hex_is_held_to_the_limit_of_hex(prefix, digits):
    rng = random.Random(3)
    for length in (20, 24, 28, 32, 40, 64):
        for _ in range(20):
            secret = "".join(rng.choice(digits) for _ in range(length))
            alone = [(len(prefix) + a, len(prefix) + b) for a, b in secrets.entropy_spans(secret)]
            for text in (prefix + secret, prefix + secret + "/end"):
                got = secrets.entropy_spans(text)
                assert all(any(a <= x and y <= b for a, b in got) for x, y in alone)
    for plain_text in ("path/to/internationalization/v2/page", "some_long_identifier_of_words_2024", "a1" + "x" * 30):
        assert not secrets.entropy_spans(plain_text)


def test_secret_spans(docs, plain):
    texts = [t for _, t, *_ in plain] + ["API-key api_key = 'AbC12345' AKIAABCDEFGHIJKL12 " + "0123456789abcdef" * 2, "ſecret=abcdefgh12 toKen=abcdefgh12", "id 123e4567-e89b-12d3-a456-426614174000 q8Zk1Lm0Pz7Xc4Vb9Nh2 averyverylongwordwithoutdigits"]
    for t in texts:
        want = sorted((m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(secrets.BASE) for m in p.finditer(t) if m.end(g) - m.start(g) >= least)
        assert secrets.base_spans(t) == want
    assert [t for t in secrets.secret_spans(texts[-1]) if t[1] == 3] == [(texts[-1].index("q8Zk"), 3, texts[-1].index("q8Zk") + 20)]
    assert docs.select(secrets.secret_report(F.col("text")).alias("r")).where("r.spans is null").count() == 0


def test_token_tables(docs, plain, empty):
    library = tokens.load(None)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rng = random.Random(2)
    alphabet = "abcdehst éèßAB  \n\t'!?.,-#&0123İΣς́가日😀\x1c\xa0"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20))) + rng.choice(["", "<|endoftext|>x", "we're"]) for _ in range(200)]
    for t in made + [t for _, t, *_ in plain if len(t) < 60]:
        t = tokens.unicodedata.normalize("NFC", t)
        table = tokens.prefix_steps([t])[0]
        assert tokens.prefix_counts(table).tolist() == [count(t[:k]) for k in range(len(t) + 1)], t
    got = docs.select("doc_id", "text", tokens.token_tables(F.col("text"), (10,)).alias("t")).collect()
    for r in got:
        text = r.text or ""
        assert r.t.n_tokens == count(text) and r.t.n_bytes == len(text.encode())
        assert r.t.fits[0] >= len(text) or count(tokens.unicodedata.normalize("NFC", text)[:r.t.fits[0]]) <= 10
    assert empty.select(tokens.token_tables(F.col("text"))).count() == 0


def test_packing(docs, plain, empty):
    library = tokens.load(None)
    rows = packing.pack(docs, window=256).collect()
    ids = {d: library.encode(t, add_special_tokens=False).ids + [2] for d, t, *_ in plain}
    sequences, pieces = defaultdict(list), Counter()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start:r.start + r.length] and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id] += r.length
    copies = Counter(d for d, *_ in plain)
    assert pieces == Counter({d: len(ids[d]) * n for d, n in copies.items()})
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 256
    assert packing.pack(empty).count() == 0


def test_packing_plan_is_the_cheapest():
    rng = random.Random(3)
    at = np.cumsum([rng.randint(1, 9) for _ in range(60)])
    penalty = np.array([rng.choice([0, 2, 32]) for _ in at])
    _, cost = packing.plan(at, penalty, 20)
    best = []
    for j, p in enumerate(at):
        best.append(min((best[i] if i >= 0 else 0) + 20 - (p - (at[i] if i >= 0 else 0)) + penalty[j] for i in range(-1, j) if p - (at[i] if i >= 0 else 0) <= 20))
    assert cost == best


def test_language_id(spark, docs, empty):
    rng = random.Random(1)
    say = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    made = [(i, lang, say(parts, 40)) for i in range(60) for lang, parts in (("xx", ["ba", "ke", "lo"]), ("yy", ["stra", "ünd", "ich"]))]
    model = language_id.train(spark.createDataFrame([(lang, t) for i, lang, t in made if i < 40], "lang string, text string"))
    rows = spark.createDataFrame([(lang, t) for i, lang, t in made if i >= 40] + [("und", None), ("und", ""), ("und", "12 ²!")], "lang string, text string")
    for r in language_id.identified(rows, model, F.col("text"), F.col("lang").alias("truth")).collect():
        assert r.truth == r.lang and 0 <= r.score <= 1
    nothing = language_id.train(empty.select("lang", "text"))
    assert {r.lang for r in language_id.identified(docs, nothing, F.col("text")).collect()} == {"und"}


def test_sequences_that_workers_do_not_hold_count_as_well(spark):
    rng = random.Random(2)
    say = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(n))
    made = [(lang, say(letters, 60)) for lang, letters in (("xx", "abcdefgh"), ("yy", "cdefgü\U00010414寿"), ("zz", "aeioukst")) for _ in range(12)]
    labelled = spark.createDataFrame(made[::2], "lang string, text string")
    texts = [t for _, t in made] + [None, "", "12 ²!", "q" * 5000, "gü a 寿", f"{'de ' * 3000}x"] * 2
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "at int, text string, grams string")
    judge = lambda model: {r.at: r for r in language_id.identified(rows, model, F.col("text"), "at").collect()}
    all_sent = language_id.train(labelled)
    assert all_sent.sent["others"] is None
    expected, total = judge(all_sent), all_sent.entries.count()
    assert sum(len(a[0]) for a in all_sent.sent["arrays"]) == total and len(expected) == len(texts)
    for most in (0, total // 10, total - 1):
        model = language_id.train(labelled, most)
        assert sum(len(a[0]) for a in model.sent["arrays"]) <= most and model.sent["others"] is not None
        got = judge(model)
        assert got.keys() == expected.keys()
        for at, e in expected.items():
            assert (got[at].lang, got[at].letters) == (e.lang, e.letters), (most, at)
            assert got[at].score == pytest.approx(e.score, abs=1e-3)
            assert got[at].bits == (None if e.bits is None else pytest.approx(e.bits, rel=1e-4))


def test_url_rules(spark):
    urls = ["http://example.com/en/1", "http://www.EXAMPLE.com/en/1", "http://a.net/fr/", "net/fr/", None, "x://net/fr/a?b#c", "x://net", "x://com/", "http://notexample.com/en/", "http://b.net/frx"]
    rules = spark.createDataFrame([("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/fr")], "verdict string, host string, path string")
    got = [(r.rule, r.verdict) for r in url_rules.judged(spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1), rules).orderBy("url").select("url", "rule", "verdict").collect()]
    want = {None: None, "http://example.com/en/1": "example.com/en/", "http://www.EXAMPLE.com/en/1": "www.example.com/en/", "http://a.net/fr/": "net/fr", "net/fr/": None,
            "x://net/fr/a?b#c": "net/fr", "x://net": None, "x://com/": "com/", "http://notexample.com/en/": "com/", "http://b.net/frx": "net/fr"}
    assert [g[0] for g in got] == [want[u] for u in sorted(urls, key=lambda u: (u is not None, u or ""))]
    assert url_rules.judged(spark.createDataFrame([("http://a.b/c",)], "url string"), rules.where("false")).first().verdict == "allow"


def test_main_text(spark):
    page = ("<html><head><title>no</title><style>p{}</style><script>var a='<p>x</p>'</script></head><body><nav><a>Menu item one two three</a></nav><div class='ad'>Buy this now</div>"
            "<article><h1>Head &amp; line</h1><p><b>First\n part.<br><p>Second &lt;part&gt;.</p><aside>Side bar text</aside><p>Third one here.</p></article>"
            "<section class='comments'><p>A reader says this and that</p></section><footer>All rights &copy; reserved by us")
    want = "Head & line\n\nFirst part.\n\nSecond <part>.\n\nThird one here."
    assert html_text.main_text(page, {}) == want and html_text.main_text("", {}) == ""
    pages = spark.createDataFrame([(page,), (None,), ("",), ("plain < text > only",)], "html string")
    weights = html_text.tag_weights(pages)
    assert [r.t for r in pages.select(html_text.main_texts(F.col("html"), weights).alias("t")).collect()][:3] == [want, "", ""]
    assert html_text.tag_weights(pages.where("false")) == {}


def test_main_text_survives_marks_of_removed_elements():
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    for page in (f"<body><svg class='a' width=\"1\"/><p>{text}</p></body>", f"<body><math/><p>{text}</p><math><mi>x</mi></math></body>",
                 f"<body><div class='layout with-sidebar'><article><p>{text}</p></article></div></body>", f"<body><div id='page-no-comments'><p>{text}</p></div></body>",
                 f"<body><article><p>{text}</p></article><div class='comments'><article><p>{text} {text} {text} more</p></article></div></body>",
                 f"<body><p>{text}</p><svg><path d='M0'/>{text} in a picture</svg><div class='sidebar'>{text[:20]} aside</div></body>"):
        assert html_text.main_text(page, {}) == text
    assert [p[0] for p in html_text.parts("<svg width=1/>a</svg>b")] == [html_text.NOT, html_text.WORD]
