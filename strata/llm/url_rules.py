"""URL filters: host-suffix and path-prefix expressions matched to rules over hash prefixes.

Each distinct URL is expanded into host-suffix + path-prefix expressions, as many as the rules can
tell apart (suffixes of the rules' label counts, prefixes of the rules' path lengths). Expressions
meet the rules in an equi-join on the first 32 bits of their SHA-256; the full digest confirms a
match, and the longest rule wins (then the longer host, then ``block``).

A rule's verdict on a URL follows from the last labels of the host and the first characters of the
path, so what is judged, and joined back, is the distinct pairs of those: a host that holds a third
of all pages is a handful of rows there. Whether the judged pairs are broadcast back is left to
the planner, which measures them at run time; otherwise the join is a sort-merge join.

Cases: a NULL URL, or one without ``://``, has an empty host and path and no rule; NULL or repeated
page ids are rows like others; with no rules every URL gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import named

#: Characters of the hexadecimal digest that are joined on (32 bits).
PREFIX_HEX = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", prefix_hex: int = PREFIX_HEX) -> DataFrame:
    """One row for each page: (id, host, path, rule, verdict). rules: (verdict, host, path) rows;
    a rule fits its host and all subdomains, if the URL's path starts with the rule's."""
    rules = rules.select("verdict", F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"))
    rules = rules.select("*", F.concat("rule_host", "rule_path").alias("rule"))
    rules = rules.select("*", F.sha2("rule", 256).alias("digest")).select("*", F.substring("digest", 1, prefix_hex).alias("short"))
    shapes = rules.agg(
        F.sort_array(F.collect_set(_labels(F.col("rule_host")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()  # distinct label counts and path lengths: a few small numbers however many rules there are
    labels, lengths = shapes["labels"] or [0], shapes["lengths"] or [0]

    seen = pages.select(named(id_col).alias("id"), host_of(named(url_col)).alias("host"), path_of(named(url_col)).alias("path"))
    tail, head = F.substring_index("host", ".", -max(labels)), F.substring("path", 1, max(lengths))
    seen = seen.select("*", tail.alias("host_tail"), head.alias("path_head"))
    expressions = (
        seen.select("host_tail", "path_head").distinct()
        .select("*", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("n")) for k in labels for n in lengths])).alias("cut"))
        .where((_labels(F.col("host_tail")) >= F.col("cut.k")) & (F.length("path_head") >= F.col("cut.n")) & (F.col("host_tail") != ""))
        .select("host_tail", "path_head", F.expr("concat(substring_index(host_tail, '.', -cut.k), substring(path_head, 1, cut.n))").alias("expression"))
        .select("host_tail", "path_head", F.sha2("expression", 256).alias("full"))
        .select("*", F.substring("full", 1, prefix_hex).alias("short"))
    )
    best = F.max(F.struct(F.length("rule").alias("size"), F.length("rule_host").alias("host_size"), "verdict", "rule"))
    judged = (
        expressions.join(rules, "short").where(F.col("full") == F.col("digest"))
        .groupBy("host_tail", "path_head").agg(best.alias("best"))
        .select("host_tail", "path_head", "best.rule", "best.verdict")
    )
    return seen.join(judged, ["host_tail", "path_head"], "left").select("id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: The rules that the query judges by.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules).withColumnRenamed("id", "page_id")


OP4_SQL = f"""
WITH rules(verdict, rhost, rpath) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
parts AS (
  SELECT page_id, row_number() OVER () AS rn,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
hits AS (
  SELECT rn, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY rn ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, verdict DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM hits WHERE k = 1) h USING (rn)
"""
