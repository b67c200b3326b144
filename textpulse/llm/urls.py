"""URL filter: pattern rules fetched by their rarest literal token.

Every rule is filed under the one of its literal tokens that the fewest URLs contain; rules
without one are tried on every URL. A URL fetches the rules filed under its own tokens, and
only those run their regular expression.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import broadcast_if_small, store

#: Fixed rules: (verdict, rule); a rule is a host and the start of a path.
HOST_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

#: Pattern rules of the method: (verdict, words that every match holds as whole tokens, pattern).
#: A word at an open end of its pattern may be the start of a longer token, so it is not listed.
#: Patterns see the lower-case URL and are written for both Java and RE2.
PATTERN_RULES = [
    ("block", ["doubleclick"], r"://([a-z0-9-]+\.)*doubleclick\.[a-z]+"),
    ("block", ["ads"], r"/ads/"),
    ("block", ["adserver"], r"[./]adserver[./]"),
    ("block", [], r"/banner[^?]*\.gif"),
    ("block", ["cheap", "pills"], r"://([a-z0-9-]+\.)*cheap-pills\."),
    ("block", ["casino"], r"[./-]casino[./-]"),
    ("block", ["viagra"], r"[./-]viagra[./-]"),
    ("block", ["porn"], r"[./-]porn[./-]"),
    ("block", ["xxx"], r"[./-]xxx[./-]"),
    ("block", ["free"], r"/free-download"),
    ("block", ["login"], r"/login\.php"),
    ("block", ["cart"], r"/cart/checkout"),
    ("block", ["track"], r"/track/pixel"),
    ("block", ["wp", "admin"], r"/wp-admin/"),
    ("block", ["cgi", "bin"], r"/cgi-bin/"),
]

TOKEN = "[^a-z0-9]+"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """Distinct runs of a-z and 0-9."""
    return F.array_distinct(F.filter(F.split(ascii_lower(text), TOKEN), lambda t: t != ""))


def rule_rows(
    host_rules: Sequence[tuple[str, str]], pattern_rules: Sequence[tuple[str, Sequence[str], str]]
) -> list[tuple]:
    """(rule number, kind, verdict, rule, host, path, pattern, tokens) of both kinds of rules.

    The tokens of a rule without any are the empty one, which every URL has.
    """
    rows = []
    for verdict, rule in host_rules:
        host, _, rest = rule.partition("/")
        words = [w for w in host.split(".") if w.isalnum()]
        # The last word of a path may be the start of a longer one, so it is no token.
        words += [w for w in rest.lower().replace("-", "/").split("/")[:-1] if w.isalnum()]
        rows.append((len(rows), "host", verdict, rule, host, "/" + rest, None, words or [""]))
    for verdict, words, pattern in pattern_rules:
        rows.append((len(rows), "pattern", verdict, None, None, None, pattern, list(words) or [""]))
    return rows


def judge(
    pages: DataFrame,
    host_rules: Sequence[tuple[str, str]] = HOST_RULES,
    pattern_rules: Sequence[tuple[str, Sequence[str], str]] = PATTERN_RULES,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(key, host, path, rule, verdict) of every row.

    The longest host rule that fits decides, ties by rule; without one, any pattern rule
    that matches blocks or allows (block wins); else ``allow``. ``rule`` is the deciding
    host rule or null. Null URLs and URLs without ``://`` have empty host and path, no rule,
    and are allowed. Every row gives one row, repeated or with a null key too.
    """
    spark = pages.sparkSession
    rules = spark.createDataFrame(
        rule_rows(host_rules, pattern_rules),
        "rule_no int, kind string, verdict string, rule string, rule_host string, rule_path string,"
        " pattern string, words array<string>",
    )
    rows = pages.select(
        F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
        F.coalesce(ascii_lower(F.col(url)), F.lit("")).alias("_url"),
    )
    # Only words of rules are counted, so the counts are at most as many as the words.
    wanted = F.array(*[F.lit(w) for w in sorted({w for r in rule_rows(host_rules, pattern_rules) for w in r[7]})])
    counts = (
        rows.select(F.explode(F.array_intersect(tokens(F.col("_url")), wanted)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    filed = (
        rules.select("*", F.explode("words").alias("word"))
        .join(counts, "word", "left")
        .groupBy("rule_no")
        .agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))["word"].alias("word"),
            *[F.first(c).alias(c) for c in ("kind", "verdict", "rule", "rule_host", "rule_path", "pattern")],
        )
    )
    filed = broadcast_if_small(store(filed.drop("rule_no"), "url-rules"), 1 << 10)
    # Equal URLs are judged once; URL tokens fetch rules, and only those are tried.
    fetched = (
        rows.select("_url", "host", "path")
        .distinct()
        .select("*", F.explode(F.concat(F.array(F.lit("")), tokens(F.col("_url")))).alias("word"))
        .join(filed, "word")
    )
    at_host = (F.col("host") == F.col("rule_host")) | F.col("host").endswith(F.concat(F.lit("."), "rule_host"))
    fits = F.when(F.col("kind") == "host", at_host & F.startswith("path", "rule_path")).otherwise(
        F.rlike("_url", "pattern")
    )
    host_rule = F.col("kind") == "host"
    longest = F.max(F.when(host_rule, F.struct(F.length("rule").alias("n"), "rule", F.col("verdict").alias("v"))))
    found = (
        fetched.filter(fits)
        .groupBy("_url", "host", "path")
        .agg(longest.alias("_best"), F.max(F.when(~host_rule, F.col("verdict"))).alias("_method"))
    )
    return rows.join(found, ["_url", "host", "path"], "left").select(
        key, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.v", "_method", F.lit("allow")).alias("verdict"),
    )


def verdict_sql(
    host_rules: Sequence[tuple[str, str]] = HOST_RULES,
    pattern_rules: Sequence[tuple[str, Sequence[str], str]] = PATTERN_RULES,
) -> str:
    """The same result for ``pages`` in DuckDB SQL, trying every rule on every URL."""
    hosts = ", ".join(
        f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in host_rules
    )
    patterns = ", ".join(f"('{v}', '{p}')" for v, _, p in pattern_rules)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH hosts(v, rule, rule_host, rule_path) AS (VALUES {hosts}),
patterns(v, pattern) AS (VALUES {patterns}),
urls AS (
  SELECT page_id, coalesce({lower.format("url")}, '') AS u,
         {lower.format("coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
one AS (SELECT DISTINCT u, host, path FROM urls),
best AS (
  SELECT u, host, path, arg_max(rule, lpad(length(rule)::varchar, 6, '0') || rule) AS rule, arg_max(v, lpad(length(rule)::varchar, 6, '0') || rule) AS v
  FROM one JOIN hosts ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL),
own AS (
  SELECT u, host, path, max(p.v) AS v FROM one JOIN patterns p ON regexp_matches(u, p.pattern) GROUP BY ALL)
SELECT page_id, urls.host, urls.path, best.rule, coalesce(best.v, own.v, 'allow') AS verdict
FROM urls LEFT JOIN best USING (u, host, path) LEFT JOIN own USING (u, host, path)"""
