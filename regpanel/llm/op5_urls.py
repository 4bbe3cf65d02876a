"""URL filter: pattern rules behind an index of their rarest literal token.

A pattern rule is a regular expression. The literal tokens that any URL it matches must hold whole are read
from its parse: runs of letters and digits outside all options and repetitions, with something else for certain at either
end. Each rule is indexed under the one of its tokens that the
fewest URLs of the table hold (counted over all of them). A URL's own tokens fetch the
candidate rules, and only those run their expression; rules without a literal token are
candidates for every URL. The rule of the highest priority that matches decides;
without one the URL is allowed.

Site rules (host and path prefix, the longest wins) come before pattern rules; the
host with its subdomains is looked up by its suffixes.

Counting is one pre-aggregated job over distinct tokens that occur in rules, so its
result is as small as the rule list. The rule list is a parameter held by
every task (``MAX_RULES`` at most, an error beyond: it is a configuration file, not a
table). Judging is a ``mapInPandas`` pass without a shuffle, one output row per page.

Defined results: a null URL, or one without ``://``, has an empty host and path and no
rule; the pattern rules still read its text (a null as empty). Repeated rows are
judged alike; an empty table gives an empty result; only the key and the URL are
read, so extra columns cannot clash. Of equally long site rules the first listed wins. Tokens that a
caller gives with a rule are taken as stated: a URL that lacks them is never tried, even if the expression fits it.
"""

from __future__ import annotations

import re
import re._constants as op
import re._parser as parser
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULES = 200_000
TOKEN = re.compile(r"[a-z0-9]+")
SCHEMA = "page_id long, host string, path string, rule string, verdict string, pattern string"


@dataclass(frozen=True)
class SiteRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """``tokens``: literal tokens (lower-case letters and digits) every matching URL holds whole; those that
    the expression tells, unless they are given."""
    name: str
    expression: str
    tokens: tuple[str, ...] | None = None
    verdict: str = "block"

    def literals(self) -> tuple[str, ...]:
        return literal_tokens(self.expression) if self.tokens is None else self.tokens


def is_inner(c: str) -> bool:
    """Whether a character is part of a token."""
    return "a" <= c <= "z" or "0" <= c <= "9"


def flattened(items) -> list:
    """A parsed sequence with its plain groups opened."""
    out = []
    for kind, value in items:
        out += flattened(value[-1]) if kind is op.SUBPATTERN and not value[1] and not value[2] else [(kind, value)]
    return out


def set_outside(members) -> bool:
    """Whether no character of a set is part of a token, for certain."""
    for kind, value in members:
        if kind is op.LITERAL and not is_inner(chr(value)):
            continue
        if kind is op.RANGE and not any(value[0] <= ord(c) <= value[1] for c in "09az"):
            continue
        if kind is op.CATEGORY and value in (op.CATEGORY_SPACE, op.CATEGORY_NOT_WORD):
            continue
        return False
    return True


def outside(items: list, at: int, step: int) -> bool:
    """Whether what stands right before (``step`` -1) or behind (1) a place is no part of a token, for certain."""
    i = at - 1 if step < 0 else at
    if not 0 <= i < len(items):
        return False
    kind, value = items[i]
    beyond = at + step

    def inner(part) -> bool:
        part = flattened(part)
        return outside(part, len(part) if step < 0 else 0, step)

    if kind is op.LITERAL:
        return not is_inner(chr(value))
    if kind is op.IN:
        return set_outside(value)
    if kind is op.AT:
        ends = (op.AT_BEGINNING, op.AT_BEGINNING_STRING) if step < 0 else (op.AT_END, op.AT_END_STRING)
        return value in ends or value is op.AT_BOUNDARY
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        return inner(value[2]) and (value[0] > 0 or outside(items, beyond, step))
    if kind is op.BRANCH:
        return all(inner(part) for part in value[1])
    if kind in (op.ASSERT, op.ASSERT_NOT):
        return outside(items, beyond, step)
    return False


def literal_tokens(expression: str) -> tuple[str, ...]:
    """Tokens that every lower-case text holds whole in which the expression is found; () if none is certain."""
    parsed = parser.parse(expression)
    if parsed.state.flags & (re.IGNORECASE | re.MULTILINE):
        return ()
    items, found, start = flattened(parsed), [], None
    for i in range(len(items) + 1):
        part = i < len(items) and items[i][0] is op.LITERAL and is_inner(chr(items[i][1]))
        if part and start is None:
            start = i
        elif not part and start is not None:
            if outside(items, start, -1) and outside(items, i, 1):
                found.append("".join(chr(c) for _, c in items[start:i]))
            start = None
    return tuple(dict.fromkeys(found))


#: The site rules of the driver's contract.
SITE_RULES = (
    SiteRule("com", "/", "allow"),
    SiteRule("example.com", "/en/", "block"),
    SiteRule("www.example.com", "/en/", "allow"),
    SiteRule("net", "/es/", "block"),
    SiteRule("net", "/fr/", "block"),
)

#: Unwanted kinds of address, in order of priority.
PATTERN_RULES = (
    PatternRule("syndication", r"[?&]utm_source=feed(?:[&#]|$)", verdict="allow"),
    PatternRule("pharmacy", r"://(?:[^/?#]*\.)?cheap-pills\."),
    PatternRule("casino", r"://(?:[^/?#]*\.)?casino-[a-z0-9]+\."),
    PatternRule("tracker", r"://(?:[^/?#]*\.)?ads-track\."),
    PatternRule("betting", r"://(?:[^/?#]*\.)?free-bets\."),
    PatternRule("referral", r"[?&]ref=x(?:[&#]|$)"),
    PatternRule("session", r"[?&](?:phpsessid|sid)=[0-9a-f]{16,}"),
)


def read_rules(spark: SparkSession, path: str) -> list[PatternRule]:
    """Pattern rules from a text file in any store Spark reads: verdict, name and expression in a line, parted by
    tabs; blank lines and those that start with ``#`` are none. Priority is by name, then expression."""
    lines = spark.read.text(path).where(F.trim("value") != "").where(~F.col("value").startswith("#"))
    rows = lines.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    out = []
    for (line,) in rows:
        verdict, name, expression = line.split("\t", 2)
        if verdict not in ("allow", "block"):
            raise ValueError(f"neither allow nor block: {line!r}")
        re.compile(expression)
        out.append(PatternRule(name, expression, verdict=verdict))
    return sorted(out, key=lambda r: (r.name, r.expression))


class Expressions(dict):
    """Rule number -> compiled expression, compiled when a URL first makes the rule a candidate."""

    def __init__(self, rules: Sequence[PatternRule]):
        super().__init__()
        self.rules = rules

    def __missing__(self, i: int) -> re.Pattern:
        self[i] = re.compile(self.rules[i].expression)
        return self[i]


def first_match(low: str, index: dict[str, list[int]], expressions: Expressions) -> int | None:
    """The rule of highest priority that fits a lower-case URL; only candidates run."""
    candidates = {i for t in {"", *TOKEN.findall(low)} for i in index.get(t, ())}
    return next((i for i in sorted(candidates) if expressions[i].search(low)), None)


def split_url(url: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min((i for i in map(path.find, "?#") if i >= 0), default=len(path))]


def rarest_tokens(pages: DataFrame, patterns: Sequence[PatternRule], url: str = "url") -> dict[str, list[int]]:
    """Index of the rules by their rarest token (the first of equals): token -> rule numbers;
    rules without tokens under ""."""
    literals = [p.literals() for p in patterns]
    wanted = sorted({t for own in literals for t in own})
    counts: dict[str, int] = {}
    if wanted:
        tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url)), F.lit("([a-z0-9]+)"), F.lit(1)))
        # The rule list's own tokens: as many as a list of MAX_RULES rules holds.
        asked = F.broadcast(pages.sparkSession.createDataFrame([(t,) for t in wanted], "token string"))
        rows = (pages.select(F.explode(tokens).alias("token")).join(asked, "token")
                .groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect())
        counts = {r["token"]: r["n"] for r in rows}
    index: dict[str, list[int]] = {}
    for i, own in enumerate(literals):
        index.setdefault(min(own, key=lambda t: counts.get(t, 0), default=""), []).append(i)
    return index


def judge_urls(pages: DataFrame, sites: Sequence[SiteRule] = SITE_RULES, patterns: Sequence[PatternRule] = PATTERN_RULES,
               key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule (of a site, else null), verdict, and the
    pattern rule that matched (null if none, or if a site rule decided)."""
    if len(sites) + len(patterns) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    by_host: dict[str, list[SiteRule]] = {}
    for s in sites:
        by_host.setdefault(s.host, []).append(s)
    index = rarest_tokens(pages, patterns, url)
    rules = tuple(patterns)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expressions = Expressions(rules)
        for f in frames:
            rows = []
            for address in f["_u"]:
                host, path = split_url(address)
                best, labels = None, host.split(".") if host else []
                for i in range(len(labels)):
                    for s in by_host.get(".".join(labels[i:]), ()):
                        # Of two that fit, the longer; a longer host comes first here.
                        if path.startswith(s.path) and (best is None or len(s.name) > len(best.name)):
                            best = s
                if best is not None:
                    rows.append((host, path, best.name, best.verdict, None))
                    continue
                found = first_match(address.lower(), index, expressions)
                hit = None if found is None else rules[found]
                rows.append((host, path, None, hit.verdict if hit else "allow", hit.name if hit else None))
            out = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict", "pattern"])
            out.insert(0, "page_id", f["page_id"].to_numpy())
            yield out

    return pages.select(F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("_u")).mapInPandas(judge, SCHEMA)


#: The same rows in DuckDB's SQL.
ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, lower(coalesce(url, '')) AS low,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), site AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM h
), pat AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN NULL
    WHEN regexp_matches(low, '[?&]utm_source=feed(?:[&#]|$)') THEN 'syndication'
    WHEN regexp_matches(low, '://(?:[^/?#]*\.)?cheap-pills\.') THEN 'pharmacy'
    WHEN regexp_matches(low, '://(?:[^/?#]*\.)?casino-[a-z0-9]+\.') THEN 'casino'
    WHEN regexp_matches(low, '://(?:[^/?#]*\.)?ads-track\.') THEN 'tracker'
    WHEN regexp_matches(low, '://(?:[^/?#]*\.)?free-bets\.') THEN 'betting'
    WHEN regexp_matches(low, '[?&]ref=x(?:[&#]|$)') THEN 'referral'
    WHEN regexp_matches(low, '[?&](?:phpsessid|sid)=[0-9a-f]{16,}') THEN 'session' END AS pattern FROM site
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN pattern IS NULL OR pattern = 'syndication' THEN 'allow' ELSE 'block' END AS verdict, pattern
FROM pat
"""
