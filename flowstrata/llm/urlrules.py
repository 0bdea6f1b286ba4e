"""URL filters: pattern rules indexed by their rarest literal token.

A pattern rule is text with ``*`` (anything) and ``^`` (a place between
alphanumeric runs); it applies to the host, the path with the query, or the
whole url, in lower case.  Its literal tokens are the alphanumeric runs with
``^`` on both sides: a url that matches must hold each of them as a token.
Every rule is filed under the one of its tokens that is rarest among all urls
(counted in one Spark pass), rules without a token under none.  The tokens of
a url fetch the candidate rules and only those run their regular expression.
An ``allow`` pattern beats every ``block`` pattern.

Before that, host and path rules (the longest that fits wins) decide.  Their
host and path are cut with DataFrame functions; see :func:`judge_urls`.

The rules go to the workers as they are: a rule list is a configuration and
does not grow with the pages.  Cases: a null url or one without ``://`` has an
empty host and path and matches host and path rules never; it is allowed
unless a pattern for the whole url blocks it; ties between patterns go to the
first in the list."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh


class PathRule(NamedTuple):
    action: str
    host: str
    path: str


class PatternRule(NamedTuple):
    action: str
    part: str  # host, path or url
    pattern: str


#: The rules of the contract, fixed values.
PATH_RULES = (PathRule("allow", "org", "/"), PathRule("block", "example.org", "/es/"),
              PathRule("block", "example.org", "/en/1"), PathRule("allow", "com", "/fr/"),
              PathRule("block", "com", "/de/"))

PATTERN_RULES = tuple(PatternRule(*r) for r in (
    ("allow", "host", "^adult^education^"), ("allow", "path", "^responsible^gambling^"),
    ("block", "host", "^spam^"), ("block", "host", "^spam^farm^"), ("block", "host", "^cheap^pills^"),
    ("block", "host", "^pills^"), ("block", "host", "^viagra^"), ("block", "host", "^casino^"),
    ("block", "host", "^casinos^"), ("block", "host", "^poker^"), ("block", "host", "^bets^"),
    ("block", "host", "^free^bets^"), ("block", "host", "^betting^"), ("block", "host", "^gambling^"),
    ("block", "host", "^adult^"), ("block", "host", "^porn^"), ("block", "host", "porn*^tube^"),
    ("block", "host", "^xxx^"), ("block", "host", "^escort^"), ("block", "host", "^ads^track^"),
    ("block", "host", "^adserver^"), ("block", "host", "^tracker^"), ("block", "host", "^warez^"),
    ("block", "host", "^torrents^"), ("block", "host", "^phishing^"), ("block", "path", "^wp^login^php^"),
    ("block", "path", "^affiliate^click^"), ("block", "path", "^online^casino^"), ("block", "url", "javascript:*"),
))

#: What precedes a pattern: if it may start anywhere, and if it starts with ``^``.
_HEAD = {"host": (r"^[^:/?#]*://[^/?#]*?", r"^[^:/?#]*:/(?:/|/[^/?#]*[^a-z0-9/?#])"),
         "path": (r"^[^:/?#]*://[^/?#]*[/?].*?", r"^[^:/?#]*://[^/?#]*[/?](?:|.*[^a-z0-9])"),
         "url": ("", "(?:^|[^a-z0-9])")}
_EDGE = "(?:[^a-z0-9]|$)"
_TOKEN = re.compile(r"[a-z0-9]+")


def regex_of(rule: PatternRule) -> str:
    """A regular expression for a lower-cased url (Python and RE2 syntax)."""
    edged = rule.pattern.startswith("^")
    joker = "[^/?#]*" if rule.part == "host" else ".*"
    body = [joker if x == "*" else _EDGE if x == "^" else re.escape(x)
            for x in re.split(r"(\*|\^)", rule.pattern[edged:])]
    return _HEAD[rule.part][edged] + "".join(body)


def literal_tokens(rule: PatternRule) -> list[str]:
    """Tokens that every matching url holds as a whole."""
    return [m.group() for m in _TOKEN.finditer(rule.pattern)
            if rule.pattern[m.start() - 1:m.start()] == "^" and rule.pattern[m.end():m.end() + 1] == "^"]


def token_counts(urls: DataFrame, url: str, rules: Sequence[PatternRule]) -> dict[str, int]:
    """In how many urls each rule token occurs, over all rows."""
    wanted = sorted({t for r in rules for t in literal_tokens(r)})
    if not wanted:
        return {}
    tokens = F.split(F.lower(F.col(url)), "[^a-z0-9]+")
    held = F.array_intersect(tokens, F.array(*map(F.lit, wanted)))
    rows = urls.select(F.explode(held).alias("token")).groupBy("token").count().collect()  # a rule token each
    return dict.fromkeys(wanted, 0) | {r["token"]: r["count"] for r in rows}


def rule_index(rules: Sequence[PatternRule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by their rarest token ("" for rules without one)."""
    index: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        rarest = min(literal_tokens(r), key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(rarest, []).append(i)
    return index


def match_urls(df: DataFrame, name: str, url: str = "url",
               rules: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """``df`` with ``struct(pattern, action)`` of the deciding pattern (null: none)."""
    rules = list(rules)
    index = rule_index(rules, token_counts(df, url, rules))
    sources = [regex_of(r) for r in rules]
    # allow patterns first, then in the order of the list
    rank = [(r.action != "allow", i) for i, r in enumerate(rules)]
    always = index.get("", [])

    @F.pandas_udf("pattern string, action string")
    def decide(urls: pd.Series) -> pd.DataFrame:
        compiled: dict[int, re.Pattern] = {}
        out = []
        for u in urls:
            low = (u or "").lower()
            fetched = list(always)
            for t in set(_TOKEN.findall(low)):
                fetched += index.get(t, ())
            hit = (None, None)
            for i in sorted(fetched, key=rank.__getitem__):
                if i not in compiled:
                    compiled[i] = re.compile(sources[i], re.DOTALL)
                if compiled[i].search(low):
                    hit = (rules[i].pattern, rules[i].action)
                    break
            out.append(hit)
        return pd.DataFrame(out, columns=["pattern", "action"])

    return df.withColumn(name, decide(F.col(url)))


def _after_scheme(url):
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def judge_urls(pages: DataFrame, path_rules: Sequence[PathRule] = PATH_RULES,
               pattern_rules: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every page."""
    rest = _after_scheme(F.col("url"))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    base = (pages.select("page_id", "url")
            .withColumn("host", F.coalesce(F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), upper, lower), F.lit("")))
            .withColumn("path", F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))))
    ordered = sorted(path_rules, key=lambda r: -len(r.host + r.path))  # the longest first
    fits = [((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
            for r in ordered]
    rule = F.coalesce(*[F.when(f, F.lit(r.host + r.path)) for f, r in zip(fits, ordered)])
    action = F.coalesce(*[F.when(f, F.lit(r.action)) for f, r in zip(fits, ordered)])
    got = fresh(base, "_got")
    return (match_urls(base, got, "url", pattern_rules)
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(action, F.col(got)["action"], F.lit("allow")).alias("verdict"),
                    F.when(action.isNull(), F.col(got)["pattern"]).alias("pattern")))


def oracle_sql(path_rules: Sequence[PathRule] = PATH_RULES,
               pattern_rules: Sequence[PatternRule] = PATTERN_RULES) -> str:
    """The same verdicts by running every expression on every url (DuckDB)."""
    ordered = sorted(path_rules, key=lambda r: -len(r.host + r.path))

    def fit(r: PathRule) -> str:
        return f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"

    rule = " ".join(f"WHEN {fit(r)} THEN '{r.host + r.path}'" for r in ordered)
    action = " ".join(f"WHEN {fit(r)} THEN '{r.action}'" for r in ordered)
    ranked = sorted(pattern_rules, key=lambda r: r.action != "allow")

    def runs(r: PatternRule) -> str:
        return f"regexp_matches(low, '{regex_of(r)}', 's')"

    pattern = " ".join(f"WHEN {runs(r)} THEN '{r.pattern}'" for r in ranked)
    verdict = " ".join(f"WHEN {runs(r)} THEN '{r.action}'" for r in ranked)
    return f"""
WITH cut AS (
  SELECT page_id, lower(coalesce(url, '')) AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, low,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {action} END AS action FROM parts)
SELECT page_id, host, path, rule,
       coalesce(action, CASE {verdict} ELSE 'allow' END) AS verdict,
       CASE WHEN action IS NULL THEN CASE {pattern} END END AS pattern
FROM ruled"""
