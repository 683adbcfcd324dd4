"""URL filters: pattern rules indexed by their rarest literal token.

Every rule names the literal tokens that any URL it fits must hold. Of those, the one that fewest URLs hold becomes the
rule's place in the index. A URL's tokens fetch the rules filed under them, and only those run their regular expression.
Where rules fit, the longest wins.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, materialize

#: Rules are a parameter that the driver holds and every executor is sent; more of them than this is an error.
MAX_RULES = 50_000
TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """name is reported; pattern is searched for in host and path; tokens are runs of a-z and 0-9 that stand alone,
    lower-cased, in every URL that the pattern fits; rank decides between rules that fit: larger first, then name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 0
    reported: bool = True


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host and all its subdomains, for paths that start with path."""
    tokens = re.findall(TOKEN, host.lower()) + re.findall(r"/([a-z0-9]+)(?=/)", path)
    return Rule(f"{host}{path}", verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(dict.fromkeys(tokens)), 1000 + len(host + path))


#: The rules that a mix of sites names: the longest that fits is reported.
SITE_RULES = (
    host_rule("net", "/", "block"),
    host_rule("example.net", "/en/", "allow"),
    host_rule("example.com", "/de/", "block"),
    host_rule("org", "/fr/", "allow"),
)
#: Patterns for pages that are no prose, for URLs that no site rule fits.
PATTERN_RULES = (
    Rule("ads host", "block", r"^(?:[^/]*[.-])?ads[.-]", ("ads",), reported=False),
    Rule("tracking host", "block", r"^(?:[^/]*[.-])?track[.-]", ("track",), reported=False),
    Rule("login page", "block", r"/login(?:[/.]|$)", ("login",), reported=False),
    Rule("cart page", "block", r"/cart(?:[/.]|$)", ("cart",), reported=False),
    Rule("feed", "block", r"/feed(?:[/.]|$)", ("feed",), reported=False),
    Rule("casino host", "block", r"^(?:[^/]*[.-])?casino[.-]", ("casino",), reported=False),
)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://, or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_tokens(rows: DataFrame, wanted: Sequence[str]) -> Column:
    """The distinct tokens of host and path that some rule names."""
    tokens = F.array_distinct(F.split(F.translate(F.concat("_host", "_path"), UPPER, LOWER), "[^a-z0-9]+"))
    return F.filter(tokens, lambda t: t.isin(*wanted)) if len(wanted) <= 1000 else tokens


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = SITE_RULES + PATTERN_RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row for each row of pages: id_col, host, path, rule, verdict.

    rule is the winning rule's name, null where none that is reported wins. A null url and one without :// have an empty
    host and path, which no rule fits. Null ids and repeated rows are judged like any others. Other columns are not
    looked at; no rows give no rows; without rules all get the default.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if bad := [r.name for r in rules if not r.tokens]:
        raise ValueError(f"rules without a literal token: {bad[:5]}")
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path"))
    if not rules:
        return rows.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    named = sorted({t for r in rules for t in r.tokens})
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in named], "token string"))  # a few tokens a rule
    held = rows.select(F.explode(url_tokens(rows, named)).alias("token")).join(wanted, "token").groupBy("token").count()
    frequency = {r["token"]: r["count"] for r in held.collect()}  # a row for each named token at most
    index = [(min(r.tokens, key=lambda t: (frequency.get(t, 0), t)), r.name, r.verdict, r.pattern, r.rank, r.reported) for r in rules]
    filed = spark.createDataFrame(index, "token string, name string, verdict string, pattern string, rank int, reported boolean")

    # The best rule that fits, url by url: distinct hosts and paths are judged once.
    urls = materialize(rows.select("_host", "_path").distinct(), "urls")
    fetched = urls.select("_host", "_path", F.explode(url_tokens(urls, [x[0] for x in index])).alias("token")).join(F.broadcast(filed), "token")
    fits = fetched.where(F.expr("concat(_host, _path) rlike pattern"))
    best = fits.groupBy("_host", "_path").agg(F.max_by(F.struct("name", "verdict", "reported"), F.struct("rank", "name")).alias("best"))
    found = rows.join(materialize(best, "judged").hint("merge"), ["_host", "_path"], "left")
    return found.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.when(F.col("best.reported"), F.col("best.name")).alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
