"""URL verdicts: path rules first, then a list of canonical URLs behind a blocked Bloom filter.

The list is hashed into a Bloom filter of 512-bit blocks (one bit in each of
eight words), built with one partial ``bit_or`` per block. Every URL looks up
its one block; URLs that miss a bit are surely not listed. Possible hits are
joined with the list itself, so false positives go. The filter's size is bounded
(see ``bloom``); a longer list makes more false hits, never fewer true ones.

Cases: a null URL or one without ``://`` has an empty host and path, fits no
rule and isn't listed; rules of equal length apply in the given order; rows of
one URL are spread over tasks; repeated rows are judged each; other columns are
ignored; an empty list or table gives ``allow`` or nothing.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.bloom import with_possible
from parcelflow.llm.common import salted_left_join, stored, table

# Verdict, host and path of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path, both empty for a null URL or one without ``://``."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    parts = [F.regexp_extract(whole, r"^(?s:.*?)://([^/?#]*)([^?#]*)", k) for k in (1, 2)]
    return F.translate(parts[0], string.ascii_uppercase, string.ascii_lowercase), parts[1]


def canonical(url: str = "url") -> Column:
    """One form per address: no scheme, ``www.``/``m.``, default port, fragment, closing slash or tracking parameter; null without host."""
    host, path = host_and_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^(www|m)\.", ""), r":(80|443)$", "")
    query = F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike("^(ref=|utm_)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/+$", ""), tail))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's name and verdict (both null without one)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of ``pages`` (``page_id, url``).

    ``listed`` holds canonical URLs in ``url_key``; URLs on it are blocked
    unless a rule says otherwise.
    """
    listed = stored(listed.where("url_key IS NOT NULL").select("url_key").distinct(), "listed-urls")
    host, path = host_and_path()
    rule, judged = rule_of(F.col("host"), F.col("path"), rules)
    urls = (
        pages.select(F.col("page_id"), F.col("url"), host.alias("host"), path.alias("path"), canonical().alias("url_key"))
        .withColumn("rule", rule)
        .withColumn("judged", judged)
    )
    probed = with_possible(urls, "url_key", listed, "url_key").drop("url")
    surely_not = probed.where("NOT possible").withColumn("listed", F.lit(False))
    exact = listed.withColumn("listed", F.lit(True))
    hits = salted_left_join(probed.where("possible"), exact, ["url_key"], "page_id")
    return (
        surely_not.unionByName(hits)
        .withColumn("listed", F.coalesce("listed", F.lit(False)))
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("judged", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
            "listed",
        )
    )


def repeated_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs that two or more page rows share: the block list of the registered query."""
    return pages.select(canonical().alias("url_key")).groupBy("url_key").count().where("count > 1").select("url_key")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, repeated_urls(pages))


OP5_SQL = r"""
WITH a AS (
    SELECT page_id, coalesce(url, '') AS u,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
b AS (
    SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path,
           regexp_extract(u, '^[^?#]*\?([^#]*)', 1) AS query
    FROM a
),
c AS (
    SELECT *, list_sort([p FOR p IN string_split(query, '&') IF p <> '' AND NOT regexp_matches(p, '^(ref=|utm_)')]) AS kept
    FROM b
),
d AS (
    SELECT page_id, host, path,
           CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
                || rtrim(path, '/') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS url_key
    FROM c
),
l AS (SELECT url_key FROM d WHERE url_key IS NOT NULL GROUP BY url_key HAVING count(*) > 1),
r(action, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
f AS (
    SELECT d.page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(action, length(rule_host || rule_path)) AS action
    FROM (SELECT DISTINCT page_id, host, path FROM d) AS d
    JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY d.page_id, d.host, d.path
)
SELECT d.page_id, host, path, rule, l.url_key IS NOT NULL AS listed,
       coalesce(action, CASE WHEN l.url_key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM d LEFT JOIN f ON f.page_id = d.page_id LEFT JOIN l ON l.url_key = d.url_key
"""
