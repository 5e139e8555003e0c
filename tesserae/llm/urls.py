"""URL filtering by rules indexed on their rarest literal token (operator 3)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, table

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A compiled rule: what it decides, the pattern over host, path and query, and its whole tokens.

    Of the rules that match, the highest rank wins, then the longest.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, its subdomains and the paths that start with ``path``."""
    whole = re.sub(r"[A-Za-z0-9]+$", "", path)  # a last token may go on in the url
    tokens = re.findall(TOKEN, host) + re.findall(TOKEN, whole.lower())
    return Rule(host + path, verdict, r"^(?:[^/?#]*\.)?" + re.escape(host + path), tuple(dict.fromkeys(tokens)), 1)


def wildcard_rule(verdict: str, text: str) -> Rule:
    """A rule in filter-list notation: ``||`` starts at a host label, ``*`` is anything, ``^`` a separator or the end."""
    anchored = text.startswith("||")
    body = text[2:] if anchored else text
    pattern = (r"^(?:[^/?#]*\.)?" if anchored else "") + "".join({"*": "(?s:.*)", "^": "(?:[^A-Za-z0-9_.%-]|$)"}.get(c) or re.escape(c) for c in body)
    tokens = [m[0].lower() for m in re.finditer("[A-Za-z0-9]+", body) if (m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and anchored) and m.end() < len(body) and body[m.end()] != "*"]
    return Rule(text, verdict, pattern, tuple(dict.fromkeys(tokens)), 0)


#: The rules that the contract names.
SITE_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: What the method blocks where no site rule fits: hosts and paths of spam, advertising and tracking.
WILDCARDS = ("||spam^", "||spam-farm^", "||spam-farm.", "||*-spam.", "||ads.", "||adserver.", "||track.", "||tracker.", "||casino.", "||porn.", "/ads/", "/adserver/", "/banner/", "/tracking/", "/casino/", "/porn/", "^utm_campaign=*&aff=")


def default_rules() -> list[Rule]:
    return [site_rule(*x) for x in SITE_RULES] + [wildcard_rule("block", x) for x in WILDCARDS]


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and the rest of a url; all empty without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    tail = F.substring(after, F.length(host) + 1, F.length(after))
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    return ascii_lower(host), path, F.substring(tail, F.length(path) + 1, F.length(tail))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``.

    Each rule lies under the one of its tokens that the fewest distinct urls
    hold, rules without a whole token under the empty one. A url fetches the
    rules under its tokens, and only those run their patterns. rule is null
    where a wildcard rule or the default decides. A null url, or one without
    ``://``, has an empty host and path and gets the default. Repeated pages
    and urls each get their row; distinct urls are judged once.
    """
    spark = pages.sparkSession
    urls = pages.select("url").where("url is not null").distinct()
    host, path, rest = parts(F.col("url"))
    urls = urls.select("url", F.concat(host, path, rest).alias("body"))
    words = urls.select("url", "body", F.explode(F.array_union(F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("body")), F.lit(f"({TOKEN})"), 1)), F.array(F.lit("")))).alias("token"))
    listed = spark.createDataFrame([(k, r.name, r.verdict, r.pattern, r.rank, len(r.name), list(r.tokens) or [""]) for k, r in enumerate(rules)], "id int, name string, action string, pattern string, rank int, long int, tokens array<string>")
    held = listed.select("id", F.explode("tokens").alias("token"))
    # tokens of rules only: the index needs no count of others
    seen = words.join(held.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = Window.partitionBy("id").orderBy(F.coalesce("count", F.lit(0)), "token")
    index = held.join(seen, "token", "left").withColumn("r", F.row_number().over(rarest)).where("r = 1").select("id", "token")
    index = index.join(listed, "id").select("token", "name", "action", "pattern", "rank", "long")
    met = words.join(index, "token").where("body rlike pattern")
    best = met.groupBy("url").agg(F.max(F.struct("rank", "long", "name", "action")).alias("best"))
    host, path, _ = parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).join(best, "url", "left")
    return rows.select("page_id", "host", "path", F.when(F.col("best.rank") == 1, F.col("best.name")).alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the verdict on every page's url.

    A null or empty url has an empty host and path, no rule and the default; a
    very long one is judged whole; of rules that fit alike the longest decides;
    repeated pages and urls each get their row; an empty table gives none;
    other columns play no part.
    """
    return judge(table(spark, sf_dir, "pages"), default_rules())


#: Every rule against every url.
ORACLE = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after FROM pages
), q AS (
  SELECT page_id, regexp_extract(after, '^[^/?#]*') AS raw, after FROM p
), h AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(after, len(raw) + 1), '^[^?#]*') AS path, substr(after, len(raw) + 1) AS tail FROM q
), m AS (
  SELECT h.page_id, h.host, h.path, arg_max(r.host || r.path, len(r.host || r.path)) AS rule, arg_max(r.verdict, len(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path, page_id FROM h) h
  JOIN (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) r(verdict, host, path)
    ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
  GROUP BY ALL
)
SELECT h.page_id, h.host, h.path, m.rule,
       coalesce(m.verdict, CASE WHEN regexp_matches(host || tail, '^([^/?#]*\.)?(spam([^A-Za-z0-9_.%-]|$)|spam-farm([^A-Za-z0-9_.%-]|$)|spam-farm\.|(?s:.*)-spam\.|ads\.|adserver\.|track\.|tracker\.|casino\.|porn\.)|/(ads|adserver|banner|tracking|casino|porn)/|[^A-Za-z0-9_.%-]utm_campaign=(?s:.*)&aff=') THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN (SELECT page_id, rule, verdict FROM m) m USING (page_id)
"""
