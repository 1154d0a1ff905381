"""The operators as queries over whole test tables, and the SQL of those that SQL can express."""

import hashlib

from pyspark.sql import functions as F

from stockyard.llm.rows import WORD, table, whole


def op1_mix_sources(spark, sf_dir):
    """Shares by word counts; sources weigh 1, 2, 3 in turn."""
    from stockyard.llm.mixing import mix_rows
    docs = table(spark, sf_dir, "documents")
    size = F.regexp_count(whole(F.col("text")), F.lit(WORD)).cast("long")
    mixed = mix_rows(docs, F.col("source"), size, F.col("doc_id"), keep=[F.col("doc_id")])
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_fingerprints(spark, sf_dir):
    """Fingerprints of every text, of its edited text and their likeness to each other and to the next document's."""
    from stockyard.llm.fingerprint import beside_next, fingerprint, likeness

    def judge(rows):
        ready = (None, None)  # the next document's text and fingerprint, from the row before
        for doc_id, text, following in rows:
            own = ready[1] if ready[0] == text else fingerprint(text)
            cut = len(text) // 3
            edited = text[:len(text) - cut] + following[:cut]
            changed = own if edited == text else fingerprint(edited)
            after = own if following == text else fingerprint(following)
            ready = following, after
            yield {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                   "fingerprint": own, "edited_fingerprint": changed, "near_edited": likeness(own, changed), "near_next": likeness(own, after)}

    return beside_next(table(spark, sf_dir, "documents"), judge,
                       "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3_exact_dedup(spark, sf_dir):
    """The group of equal texts of every document."""
    from stockyard.llm.exact_dedup import duplicate_groups
    return duplicate_groups(table(spark, sf_dir, "documents"), hash_all=True).drop("__row")


OP3_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s FROM documents),
g AS (SELECT s, count(*) AS group_size FROM t GROUP BY s),
b AS (SELECT s, doc_id AS keep_id FROM (SELECT s, doc_id, row_number() OVER (PARTITION BY s ORDER BY n DESC, doc_id NULLS LAST) AS k FROM t) WHERE k = 1)
SELECT t.doc_id, b.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM b.keep_id AS kept, t.s AS text_sha256
FROM t JOIN g USING (s) JOIN b USING (s)"""


def op4_near_dedup(spark, sf_dir):
    """The class of near duplicates of every document."""
    from stockyard.llm.near_dedup import near_classes
    return near_classes(table(spark, sf_dir, "documents")).drop("__row")


def op5_secret_scan(spark, sf_dir):
    """Secrets in every text."""
    from stockyard.llm.secrets import secret_report
    return table(spark, sf_dir, "documents").select("doc_id", secret_report(whole(F.col("text"))).alias("r")).select("doc_id", "r.*")


def op6_token_counts(spark, sf_dir):
    """Token counts of every text from its table of prefix counts, and where 2048 tokens end."""
    from stockyard.llm.tokens import token_tables
    counted = table(spark, sf_dir, "documents").select("doc_id", token_tables(whole(F.col("text")), (2048,)).alias("t"))
    return counted.select("doc_id", "t.n_bytes", "t.n_tokens", (F.col("t.n_tokens") > 2048).alias("over_limit"), F.col("t.fits")[0].alias("fits_2048"))


def op7_pack(spark, sf_dir):
    """All texts in windows of 4096 tokens."""
    from stockyard.llm.packing import pack
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_language_id(spark, sf_dir):
    """The language of every text, learned from the labels of three quarters of the documents."""
    from stockyard.llm.language_id import held_out, identified, learnable, train
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(learnable(docs)).select("lang", whole(F.col("text")).alias("text")))
    judged = identified(docs, model, F.col("text"), "doc_id", held_out(F.col("doc_id")).alias("held_out"))
    return judged.select("doc_id", "held_out", F.col("lang").alias("lang_pred"), "score")


#: The rules of the query: verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op9_url_rules(spark, sf_dir):
    """The rule that decides on every page's URL."""
    from stockyard.llm.url_rules import judged
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = r"""
WITH rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, regexp_extract(rest, '^([^/?#]*)', 1) AS h, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
l AS (SELECT page_id, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM p),
m AS (SELECT l.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM l JOIN rules ON (l.host = rhost OR ends_with(l.host, '.' || rhost)) AND starts_with(l.path, rpath) GROUP BY l.page_id)
SELECT l.page_id, l.host, l.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM l LEFT JOIN m USING (page_id)"""


def op10_main_text(spark, sf_dir):
    """The main text of every page, with tag weights from the pages that mark their content."""
    from stockyard.llm.html_text import main_texts, tag_weights
    pages = table(spark, sf_dir, "pages")
    texts = pages.select("page_id", "url", main_texts(F.col("html"), tag_weights(pages)).alias("text"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_shards(spark, sf_dir):
    """Eight shards of nearly equal bytes, copies of a text together."""
    from stockyard.llm.sharding import shard_rows
    rows = shard_rows(table(spark, sf_dir, "documents"), 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_collocations(spark, sf_dir):
    """The 2000 phrases of each language whose words belong together most."""
    from stockyard.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, s, array_to_string(ws[i:i + s - 1], ' ') AS phrase FROM (SELECT lang, ws, s, unnest(range(1, CAST(len(ws) AS BIGINT) - s + 2)) AS i FROM p, (VALUES (1), (2), (3)) sizes(s))),
f AS MATERIALIZED (SELECT lang, s, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE s = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, s, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE s > 1 AND a >= 10),
x AS MATERIALIZED (SELECT lang, s, phrase, a, k, array_to_string(ws[1:k], ' ') AS before, array_to_string(ws[k + 1:s], ' ') AS behind
      FROM (SELECT *, unnest(range(1, s)) AS k FROM c)),
k AS (SELECT x.lang, x.s, x.phrase, x.a, x.k, l.a AS l, r.a AS r, CAST(CAST(1000000 AS HUGEINT) * x.a * x.a // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.before JOIN f r ON r.lang = x.lang AND r.phrase = x.behind),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM k) WHERE cut = 1),
o AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM c WHERE s = 3 UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM c WHERE s = 3) GROUP BY ALL),
t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b LEFT JOIN o ON b.s = 2 AND o.lang = b.lang AND o.phrase = b.phrase
      WHERE o.most IS NULL OR 100 * o.most < 50 * b.a)
SELECT t.lang, t.rank, t.phrase, t.a, t.l, t.r, n.n, t.score FROM t JOIN n ON n.lang = t.lang WHERE t.rank <= 2000"""


def op13_alignment(spark, sf_dir):
    """Groups and links of the tokens of two vocabularies in every text, with the corpus counts of the links."""
    from stockyard.llm.alignment import aligned, pair_counts
    docs = table(spark, sf_dir, "documents")
    return aligned(docs, pair_counts(docs), with_groups=False)


def queries():
    return {f.__name__: f for f in (op1_mix_sources, op2_fingerprints, op3_exact_dedup, op4_near_dedup, op5_secret_scan, op6_token_counts, op7_pack, op8_language_id,
                                    op9_url_rules, op10_main_text, op11_shards, op12_collocations, op13_alignment)}


def oracle_sql():
    return {"op3_exact_dedup": OP3_SQL, "op9_url_rules": OP9_SQL, "op12_collocations": OP12_SQL}
