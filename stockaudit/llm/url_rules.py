"""URL filters by host-suffix and path-prefix expressions (operator 9).

Every url is expanded into the expressions (last k labels of its host, first n characters of its path) that a rule
could have; these meet the rules in an equality join on the first four bytes of their SHA-256, the full digest confirms,
and the longest rule decides.

Only the label counts and path lengths that occur among the rules are expanded. Both lists are read from the rules and
are bounded: a rule's host has at most ``MAX_LABELS`` labels and its path at most ``MAX_PATH`` characters; rules beyond
that are refused with an error. The number of rules is not bounded: they are never collected or broadcast by hint.

Defined results: a null url, or one without ``://``, has an empty host and an empty path and fits no rule. Repeated
pages give repeated rows. A rule stated twice counts once; if it is stated with both verdicts, block wins. An empty rule
table gives the default verdict everywhere. Extra columns of the pages are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.common import lower_ascii, table

MAX_LABELS, MAX_PATH = 127, 2048
PREFIX_BYTES = 4

#: The rules of the registered query: (host, path, verdict).
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; then up to ``?``, ``#`` or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^([^?#]*)", 1)
    return lower_ascii(host), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page; see the module's text."""
    shape = rules.select(
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("chars")).distinct()
    kinds = shape.agg(F.max("labels"), F.max("chars"), F.collect_set("labels"), F.collect_set("chars")).first()
    if (kinds[0] or 0) > MAX_LABELS or (kinds[1] or 0) > MAX_PATH:
        raise ValueError(f"a rule has over {MAX_LABELS} labels or over {MAX_PATH} characters of path")

    host, path = host_and_path(F.col("url"))
    judged = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    labels = F.size(F.split("host", r"\."))
    hosts = F.array(*(F.when(labels >= n, F.substring_index("host", ".", -n)) for n in sorted(kinds[2])))
    paths = F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(kinds[3])))

    full = _digest(F.col("rule_host"), F.col("rule_path"))
    known = rules.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict")).select(
        full.alias("digest"), F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict",
        F.length("rule_host").alias("host_chars"))
    known = known.withColumn("short", F.substring("digest", 1, 2 * PREFIX_BYTES))
    asked = (
        judged.select("*", F.explode(hosts).alias("h")).where("h is not null")
        .select("*", F.explode(paths).alias("p")).where("p is not null")
        .withColumn("asked", _digest(F.col("h"), F.col("p")))
        .withColumn("short", F.substring("asked", 1, 2 * PREFIX_BYTES)).drop("h", "p")
    )
    best = F.max(F.struct(F.length("rule").alias("n"), "host_chars", "rule", "rule_verdict"))
    hit = asked.join(known, "short").where(F.col("asked") == F.col("digest")).groupBy("row").agg(best.alias("best"))
    return judged.join(hit, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rules_frame(spark))


SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts
), judged AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts
), rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
)
SELECT page_id, host, path,
       (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT arg_max(rule_verdict, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM judged
"""
