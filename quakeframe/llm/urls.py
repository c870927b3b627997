"""URL filters: pattern rules indexed by their rarest literal token.

A rule is either a host with a path prefix, which fits the host and all its
subdomains, or a pattern over host and path in which * stands for anything and ^
for a separator (no ASCII letter or digit) or an end. Its literal tokens are the
runs of ASCII letters and digits with a fixed end on both sides; the one that
fewest URLs of the table hold indexes the rule. A URL's tokens fetch candidate
rules, and only those run their regular expressions. Rules without such a token
are candidates for every URL. All of it is DataFrame expressions.

Null URLs and URLs without :// have an empty host and path, and no rule with a
host fits them. Null and repeated ids are fine, as rows are judged one by one.
Columns named like an output column are replaced, further ones stay.
"""

from __future__ import annotations

import json
import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.session import materialize

#: Rules up to this number are broadcast; more are joined by a shuffle.
BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class UrlRule:
    """Either host and path, or pattern. Host rules come before patterns, then the longest rule wins."""

    verdict: str
    host: str = ""
    path: str = ""
    pattern: str = ""

    @property
    def name(self) -> str:
        return self.pattern or self.host + self.path

    @property
    def regex(self) -> str:
        if not self.pattern:
            return rf"^(?:[^/]*\.)?{re.escape(self.host + self.path)}"
        special = {"*": ".*", "^": "(?:^|[^A-Za-z0-9]|$)"}
        return "(?s)" + "".join(special.get(c) or re.escape(c) for c in self.pattern)

    def tokens(self) -> list[str]:
        """Literal tokens that any URL which the rule fits holds whole."""
        if not self.pattern:
            text = f"^{self.host}{self.path}*"
        else:
            text = f"*{self.pattern}*"
        return sorted({m[0] for m in re.finditer(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?![A-Za-z0-9*])", text)})


#: The rules of the contract.
HOST_RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)
PATTERN_RULES = (
    UrlRule("block", pattern="^spam-farm^"),
    UrlRule("block", pattern="^cheap-pills^"),
    UrlRule("block", pattern="^casino^"),
    UrlRule("block", pattern="^online-casino^"),
    UrlRule("block", pattern="^free-download^"),
    UrlRule("block", pattern="^adserver^"),
    UrlRule("block", pattern="/ads/*.js^"),
    UrlRule("block", pattern="^doubleclick.net^"),
    UrlRule("allow", pattern="^casino^*/history/"),
    UrlRule("block", pattern="^porn^"),
    UrlRule("block", pattern="^xxx^"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Between the first :// and /, ?, # or the end with A-Z lower-cased; then up to ?, # or the end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _rows(df: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    return df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def rule_index(urls: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """One row a rule with its rarest token among urls (tokens array), '' where it has none."""
    rows = [{"name": r.name, "verdict": r.verdict, "by_host": not r.pattern, "regex": r.regex, "token": t} for r in rules for t in r.tokens() or [""]]
    posted = _rows(urls, rows, "name:string,verdict:string,by_host:boolean,regex:string,token:string")
    wanted = posted.select("token").distinct()
    wanted = F.broadcast(wanted) if len(rows) <= BROADCAST_RULES else wanted
    counts = urls.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    counted = posted.join(F.broadcast(counts) if len(rows) <= BROADCAST_RULES else counts, "token", "left")
    first = F.min_by(F.col("token"), F.struct(F.coalesce("urls", F.lit(0)), "token"))
    return counted.groupBy("name", "verdict", "by_host", "regex").agg(first.alias("token"))


def judge(df: DataFrame, rules: tuple[UrlRule, ...] = HOST_RULES + PATTERN_RULES, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """Adds host, path, rule (the host rule that decides, else null), pattern (the pattern that decides, else null) and verdict."""
    base = df.drop("host", "path", "rule", "pattern", "verdict", "__row")
    host, path = host_and_path(F.col(url))
    split = base.withColumn("__row", F.monotonically_increasing_id()).withColumn("host", host).withColumn("path", path)
    rows = materialize(split, "urls")
    whole = F.concat("host", "path")
    urls = rows.select("__row", whole.alias("whole")).withColumn("tokens", F.array_append(F.array_distinct(F.regexp_extract_all("whole", F.lit("[A-Za-z0-9]+"), F.lit(0))), F.lit("")))
    index = rule_index(urls, rules)
    index = F.broadcast(index) if len(rules) <= BROADCAST_RULES else index
    tried = urls.select("__row", "whole", F.explode("tokens").alias("token")).join(index, "token").where(F.expr("whole rlike regex"))
    order = F.struct("by_host", F.length("name"), "name")
    decided = tried.groupBy("__row").agg(F.max_by(F.struct("name", "by_host", "verdict"), order).alias("d"))
    out = rows.join(decided, "__row", "left")
    return out.select(
        *base.columns,
        "host",
        "path",
        F.when(F.col("d.by_host"), F.col("d.name")).alias("rule"),
        F.when(~F.col("d.by_host"), F.col("d.name")).alias("pattern"),
        F.coalesce("d.verdict", F.lit(otherwise)).alias("verdict"),
    )


def duckdb_sql(rules: tuple[UrlRule, ...] = HOST_RULES + PATTERN_RULES) -> str:
    """The same verdicts over pages, each rule tried on each URL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(r.name)}, {quoted(r.verdict)}, {not r.pattern}, {quoted(r.regex)})" for r in rules)
    return f"""
WITH rules(name, verdict, by_host, regex) AS (VALUES {values}),
cut AS (SELECT page_id, row_number() OVER () AS n, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
heads AS (SELECT page_id, n, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
parts AS (SELECT page_id, n, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM heads),
tried AS (SELECT n, name, verdict, by_host, row_number() OVER (PARTITION BY n ORDER BY by_host DESC, length(name) DESC, name DESC) AS k FROM parts, rules WHERE regexp_matches(host || path, regex))
SELECT page_id, host, path, CASE WHEN by_host THEN name END AS rule, CASE WHEN NOT by_host THEN name END AS pattern, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM tried WHERE k = 1) USING (n)"""
