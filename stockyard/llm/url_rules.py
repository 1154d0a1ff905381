"""URL filters by host and path rules.

Every URL is expanded into its host suffixes and the beginnings of its path that end in a slash. Each pair's SHA-256 is
compared by its first 32 bits in an equi-join with the rules, and a hit counts only if the whole digest and the rule's full path
agree. Of several rules the longest wins.

The work is per distinct (host, path). Expansions are as deep as the deepest rule, no deeper; deeper ones could not match.

Defined results: a NULL URL or one without ``://`` has an empty host and path and no rule; of rules of equal length the one with the longer host wins, then
the smaller by code point, ``allow`` before ``block``; repeated rows are judged alike; extra columns are kept and win over nothing; no rules: all URLs get the default.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _suffixes(host: Column, most: int) -> Column:
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.greatest(F.size(labels) - most, F.lit(0)) + 1, F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _beginnings(path: Column, most: int) -> Column:
    """The empty beginning and those up to each of the first ``most`` slashes."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most))),
                       lambda i: F.when(i > 0, F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))).otherwise(F.lit("")))


def judged(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains of it, if the URL's path starts with the rule's.
    """
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    located = urls.withColumn("__url", F.col(f"`{url}`")).select(*[F.col(f"`{c}`") for c in keep], url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"))
    keyed = rules.dropDuplicates(["host", "path", "verdict"]).select(
        F.col("host").alias("__rhost"), F.col("path").alias("__rpath"), F.col("verdict").alias("__verdict"), F.regexp_extract("path", "^(.*/)?", 0).alias("__key"))
    labels, slashes = keyed.agg(F.max(F.size(F.split("__rhost", r"\."))), F.max(F.length("__key") - F.length(F.replace("__key", F.lit("/"), F.lit(""))))).first()
    if labels is None:
        return located.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keyed = keyed.withColumn("__rdigest", _digest(F.col("__rhost"), F.col("__key"))).withColumn("__short", F.conv(F.substring("__rdigest", 1, 8), 16, 10).cast("long"))

    distinct = located.where("host != ''").select("host", "path").distinct()
    expanded = (distinct.select("host", "path", F.explode(_suffixes(F.col("host"), labels)).alias("__suffix"))
                .select("host", "path", "__suffix", F.explode(_beginnings(F.col("path"), slashes)).alias("__begin"))
                .withColumn("__digest", _digest(F.col("__suffix"), F.col("__begin")))
                .select("host", "path", "__digest", F.conv(F.substring("__digest", 1, 8), 16, 10).cast("long").alias("__cut")))
    hits = (expanded.join(keyed, F.col("__cut") == F.col("__short"))
            .where((F.col("__digest") == F.col("__rdigest")) & F.startswith(F.col("path"), F.col("__rpath"))))
    rule = F.concat("__rhost", "__rpath")
    order = F.struct((-F.length(rule)).alias("a"), (-F.length("__rhost")).alias("b"), rule.alias("c"), F.col("__verdict").alias("d"))
    best = hits.groupBy("host", "path").agg(F.min(order).alias("__best")).select(F.col("host").alias("__h"), F.col("path").alias("__p"), "__best")
    out = located.join(best, (F.col("host") == F.col("__h")) & (F.col("path") == F.col("__p")), "left")
    return out.select(*[F.col(f"`{c}`") for c in keep], "host", "path", F.col("__best.c").alias("rule"), F.coalesce("__best.d", F.lit(default)).alias("verdict"))
