"""URL filters: host-suffix and path-prefix expressions joined to rules on short hash prefixes.

Every URL is expanded into the expressions (host suffix, directory prefix of the path). A rule is keyed
the same way: its host and its path up to the last slash. Expressions and rules meet in an equi-join on
the first 4 bytes of the expression's SHA-256; the full digests are then compared, the rest of the rule's
path is checked, and the longest fitting rule wins. DataFrame functions only: no Python on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8  # 4 bytes of the digest

# The rules of the registered query (verdict, host, path).
FIXED_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"\A([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*(/[^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, most_labels: Column | int) -> Column:
    """The host and its parent domains, at most ``most_labels`` labels long."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    count = F.least(n, F.lit(most_labels))
    return F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."),
    )


def path_directories(path: Column, most_slashes: Column | int) -> Column:
    """The prefixes of the path that end with a slash (``/a/b`` gives ``/`` and ``/a/``)."""
    parts = F.split(path, "/", -1)
    count = F.least(F.size(parts) - 1, F.lit(most_slashes))
    return F.when(
        count > 0,
        F.transform(F.sequence(F.lit(1), count), lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))


def _digest(host: Column, directory: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, directory).cast("binary"), 256)


def url_filter(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules``: ``verdict``, ``host``, ``path`` (all strings; the path starts with a slash). A rule fits its
    host and all subdomains if the URL's path starts with the rule's path. The longest rule text wins; ties
    go to the longer host, then to the smaller text, then to ``block``. Rules with a null are ignored.

    Null URLs and URLs without ``://`` have empty host and path and fit no rule; ``verdict`` is then
    ``default``. Rows that repeat stay repeated; an empty table gives an empty result. Columns of ``pages``
    named like the results are replaced.

    Rules are matched once per distinct URL, so a URL that repeats in a third of all rows costs one match;
    the join back to the pages is an ordinary equi-join that adaptive execution splits when it is skewed.
    Whether the rules are broadcast is left to Spark, which knows their size.
    """
    rules = rules.select(F.lower("verdict").alias("_v"), F.translate("host", UPPER, LOWER).alias("_rh"), F.col("path").alias("_rp"))
    rules = rules.dropna().where(F.col("_rp").startswith("/")).distinct()
    rules = rules.select(
        "*",
        F.regexp_extract("_rp", r"\A(.*/)", 1).alias("_dir"),
        F.size(F.split("_rh", r"\.", -1)).alias("_labels"),
    ).withColumn("_full", _digest(F.col("_rh"), F.col("_dir")))
    # Two numbers about the rules bound the expansion: no suffix or directory longer than any rule's is made.
    most = rules.agg(F.max("_labels"), F.max(F.size(F.split("_dir", "/", -1)) - 1)).first()
    labels, slashes = (most[0] or 1), (most[1] or 1)
    rules = rules.withColumn("_short", F.substring("_full", 1, PREFIX_HEX))

    urls = pages.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    urls = urls.select("_url", url_host(F.col("_url")).alias("_h"), url_path(F.col("_url")).alias("_p"))
    expressions = (
        urls.where(F.col("_p") != "")
        .select("*", F.explode(host_suffixes(F.col("_h"), labels)).alias("_suffix"))
        .select("*", F.explode(path_directories(F.col("_p"), slashes)).alias("_prefix"))
        .select("_url", "_p", _digest(F.col("_suffix"), F.col("_prefix")).alias("_digest"))
        .withColumn("_short", F.substring("_digest", 1, PREFIX_HEX))
    )
    text = F.concat("_rh", "_rp")
    hits = (
        expressions.join(rules, "_short")
        .where((F.col("_digest") == F.col("_full")) & F.expr("startswith(_p, _rp)"))
        .groupBy("_url")
        .agg(
            F.min(
                F.struct(
                    (-F.length(text)).alias("a"),
                    (-F.length("_rh")).alias("b"),
                    text.alias("rule"),
                    F.when(F.col("_v") == "block", 0).otherwise(1).alias("c"),
                    F.col("_v").alias("verdict"),
                )
            ).alias("_best")
        )
    )
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict") or c == url]
    rows = pages.select(F.struct(*kept).alias("row"), F.col(url).alias("_u")).join(hits, F.col("_u") == F.col("_url"), "left")
    return rows.select(
        "row.*",
        url_host(F.col("_u")).alias("host"),
        url_path(F.col("_u")).alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
    )
