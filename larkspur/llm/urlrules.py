"""URL filter: pattern rules found by their rarest literal token, in DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import saved
from larkspur.operators.joins import sliced_join

TOKEN = "[a-z0-9-]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A token that every URL carries; rules without a literal token of their own are posted under it.
ANY = "*"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regular expression over host and path. ``tokens`` are literals that
    stand whole in every URL it fits. Among fitting rules the highest rank wins."""

    name: str | None
    verdict: str
    pattern: str
    tokens: tuple[str, ...] = ()
    rank: int = 0


def prefix_rule(verdict: str, text: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the path starts with the rule's path."""
    host, slash, path = text.partition("/")
    if not host or not slash:
        raise ValueError(f"a rule is a host, a slash and the start of a path: {text!r}")
    whole = f"{host}{slash}{path}"
    closed = whole[: whole.rindex("/") + 1].lower()
    return Rule(text, verdict, rf"^(?:[^/]*\.)?\Q{whole}\E", tuple(re.findall(TOKEN, closed)), len(text))


#: The method's own patterns, for URLs that no prefix rule fits: hosts that sell or spam.
JUNK_HOSTS = tuple(
    Rule(None, "block", rf"^(?:[^/]*\.)?{name}\.", (name,), -1) for name in ("spam-farm", "cheap-pills", "casino-win", "adult-x")
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path; both empty for null or without ``://``."""
    cut = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, cut, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def judge(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url", keep: Sequence[str] = ()
) -> DataFrame:
    """Rows with ``host``, ``path``, ``rule`` and ``verdict``; ``keep`` names columns to carry.

    Each rule is posted under the rarest of its tokens, by the number of URLs that hold
    it over the whole table: the count is an aggregate with one row per token of a rule,
    so what reaches the driver is bounded by the rule list, which the caller holds
    there. A URL looks its distinct tokens up and only the rules posted there run their
    regular expression; nothing is shuffled but the token counts. Highest rank wins,
    then the pattern later by code point.

    Null, empty or malformed URLs have empty host and path and get the default. Repeated
    rows are judged alike, an empty table gives no rows, and columns that clash with the
    new names are replaced.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(*keep, host.alias("host"), path.alias("path"))
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(TOKEN), F.lit(0)))
    wanted = sorted({t for r in rules for t in r.tokens})
    seen: dict[str, int] = {}
    if any(len(set(r.tokens)) > 1 for r in rules):
        found = parts.select(F.explode(F.array_intersect(tokens, F.array(*map(F.lit, wanted)))).alias("token"))
        seen = {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}
    posted: dict[str, list[Rule]] = {}
    for r in rules:
        posted.setdefault(min(r.tokens, key=lambda t: (seen.get(t, 0), t), default=ANY), []).append(r)
    if not posted:
        return parts.select(*keep, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    as_struct = lambda r: F.struct(
        F.lit(r.rank).alias("rank"), F.lit(r.pattern).alias("pattern"), F.lit(r.name).cast("string").alias("name"), F.lit(r.verdict).alias("verdict")
    )
    index = F.create_map(*[x for t, rs in sorted(posted.items()) for x in (F.lit(t), F.array(*map(as_struct, rs)))])
    asked = F.filter(F.concat(tokens, F.array(F.lit(ANY))), lambda t: t.isin(sorted(posted)))
    candidates = F.flatten(F.transform(asked, lambda t: index[t]))
    target = F.concat("host", "path")
    best = F.array_max(F.filter(candidates, lambda r: F.regexp_like(target, r["pattern"])))
    return parts.withColumn("__best", best).select(
        *keep, "host", "path", F.col("__best.name").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict")
    )


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules as rows, the form in which long lists are kept."""
    rows = [(r.name, r.verdict, r.pattern, list(r.tokens), r.rank) for r in rules]
    return spark.createDataFrame(rows, "name string, verdict string, pattern string, tokens array<string>, rank int")


def judge_by_table(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """``judge`` for rule lists of any length, which stay a table (name, verdict, pattern, tokens, rank).

    The rules' tokens are counted over all URLs, each rule is posted under its rarest one, and
    distinct (host, path) pairs meet the posted rules in a join on the token; only what meets runs a regular
    expression. A token that very many URLs hold is dealt over slices, and a URL's best rule is a maximum
    taken before the shuffle. Nothing is collected; Spark broadcasts a side only if it is small. Results,
    nulls, ties, repeats and clashing names are those of ``judge``.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(*keep, host.alias("host"), path.alias("path"))
    named = F.array_distinct(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(TOKEN), F.lit(0)))
    where = saved(parts.groupBy("host", "path").agg(F.count("*").alias("n")), "urls")
    tokens = where.select("host", "path", "n", F.explode(F.concat(named, F.array(F.lit(ANY)))).alias("token"))
    of = rules.select(F.struct("rank", "pattern", "name", "verdict").alias("rule"), F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    own = of.select("rule", F.explode(F.when(F.size("tokens") > 0, F.array_distinct("tokens")).otherwise(F.array(F.lit(ANY)))).alias("token"))
    wanted = own.select("token").distinct()
    seen = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.sum("n").alias("n"))
    rarest = F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), F.col("token"))).alias("token")
    posted = saved(own.join(seen, "token", "left").groupBy("rule").agg(rarest), "posted")
    asked = tokens.join(posted.select("token").distinct(), "token", "left_semi").drop("n")
    met = sliced_join(asked, posted, ["token"], F.xxhash64("host", "path"))
    fits = met.where(F.regexp_like(F.concat("host", "path"), F.col("rule.pattern")))
    best = fits.groupBy("host", "path").agg(F.max("rule").alias("__best"))
    judged = saved(where.select("host", "path").join(best, ["host", "path"], "left"), "judged")
    out = sliced_join(parts.withColumn("__row", F.monotonically_increasing_id()), judged, ["host", "path"], F.col("__row"), "left")
    return out.select(*keep, "host", "path", F.col("__best.name").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))


PREFIX_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

SQL = r"""
WITH cut AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM cut)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches('.' || host, '\.(spam-farm|cheap-pills|casino-win|adult-x)\.') THEN 'block' ELSE 'allow' END AS verdict
FROM fit
"""
