"""URL filter: pattern rules, indexed by their rarest literal token.

A rule is a regular expression over ``host + path``.  A url's tokens are its runs of ASCII
letters and digits, in lower case.  The tokens that every url must hold that a rule fits are
derived from the parsed expression: literal runs between places where no letter or digit
can stand.  How often each rule token occurs is counted over all urls; a rule is filed under
its rarest token.  A url's tokens fetch the rules filed under them, and only these rules run
their expressions; a rule without such a token runs on every url.

Of the site rules that fit, the one of longest pattern decides.  Where none fits, the
pattern rules of the method decide: any that fits blocks, else the url is allowed.

The rules are a parameter, a sequence or a table (``rules_from``).  A task holds at most
``RULES_BYTES`` of patterns.  More rules are dealt into shards by the token that they are
filed under, and the urls pass one shard after the other; what was found so far is written
in between, so any number of rules is judged exactly.

Defined cases: a null url, or one without ``://``, has empty host and path, so no rule
fits and it is allowed.  Extra columns pass through; host, path, rule and verdict are
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _parser as sre

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.components import written

RULES_BYTES = 16 << 20
_TOKEN = re.compile(r"[0-9a-z]+")


@dataclass(frozen=True)
class Rule:
    name: str                  # as reported
    pattern: str               # searched in host + path
    verdict: str
    site: bool = False         # decides by itself, longest name first

    @property
    def tokens(self) -> tuple[str, ...]:
        """Whole tokens of every url that fits.  Pattern rules see the url in lower case."""
        return required_tokens(self.pattern, not self.site)


# ---------------------------------------------------------------- required tokens

WALL, OPEN = "wall", "open"    # no token character can stand there; anything can


_LOWER = frozenset(map(ord, "0123456789abcdefghijklmnopqrstuvwxyz"))
_BOTH = _LOWER | frozenset(map(ord, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))


def _walled(arg, token: frozenset[int]) -> bool:
    """Does this set fit none of the token characters?"""
    fits = set()
    for kind, x in arg:
        if kind is sre.LITERAL:
            fits.add(x)
        elif kind is sre.RANGE:
            fits |= {c for c in token if x[0] <= c <= x[1]}
        elif kind is not sre.NEGATE:
            return False
    return token <= fits if arg[0][0] is sre.NEGATE else not token & fits


def _items(parsed, token: frozenset[int]) -> list:
    """The pattern as literal characters, walls and open places."""
    out: list = []
    for op, arg in parsed:
        if op is sre.LITERAL:
            out.append(chr(arg).lower() if arg in _BOTH else WALL)
        elif op is sre.IN:
            out.append(WALL if _walled(arg, token) else OPEN)
        elif op is sre.AT:
            out.append(WALL if arg in (sre.AT_BEGINNING, sre.AT_BEGINNING_STRING, sre.AT_END, sre.AT_END_STRING, sre.AT_BOUNDARY) else OPEN)
        elif op is sre.SUBPATTERN:
            out += _items(arg[3], token) if not arg[1] and not arg[2] else [OPEN]
        elif op is sre.BRANCH:
            ways = [_items(way, token) for way in arg[1]]
            out.append(WALL if all(way and set(way) == {WALL} for way in ways) else OPEN)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            inner = _items(arg[2], token)
            if arg[0] >= 1 and inner and set(inner) == {WALL}:
                out.append(WALL)
            else:
                # after a wall and an optional part that ends in a wall, there is a wall either way
                after = WALL if out and out[-1] == WALL and inner and inner[-1] == WALL else OPEN
                out += [OPEN, after]
        else:
            out.append(OPEN)
    return out


@lru_cache(maxsize=1 << 16)
def required_tokens(pattern: str, lowered: bool) -> tuple[str, ...]:
    """Tokens that are whole in every text (``lowered``: without A-Z) in which ``pattern`` is found."""
    found, run, walled = [], "", False
    for item in [OPEN, *_items(sre.parse(pattern, re.ASCII), _LOWER if lowered else _BOTH), OPEN]:
        if item in (WALL, OPEN):
            if run and walled and item == WALL:
                found.append(run)
            run, walled = "", item == WALL
        else:
            run += item
    return tuple(dict.fromkeys(found))


# ---------------------------------------------------------------- rules


def site_rule(verdict: str, name: str) -> Rule:
    """A rule for a host, all its subdomains and the paths that start with its path."""
    host, slash, rest = name.partition("/")
    return Rule(name, rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + rest)}", verdict, True)


# fixed values: the site rules of the contract
SITE_RULES = (site_rule("block", "net/"), site_rule("allow", "example.net/en/"),
              site_rule("block", "example.com/de/"), site_rule("allow", "org/fr/"))


def word_rule(*words: str) -> Rule:
    """Blocks hosts or paths in which the words follow each other, joined by a sign."""
    between = r"[-_.]"
    body = between.join(map(re.escape, words))
    return Rule("*" + "-".join(words) + "*", rf"(?:\A|[^0-9a-z]){body}(?:[^0-9a-z]|\Z)", "block")


PATTERN_RULES = (word_rule("cheap", "pills"), word_rule("casino", "win"), word_rule("spam", "farm"),
                 word_rule("free", "bets"), word_rule("ads", "track"), word_rule("adult", "x"))


def host_of(url: str | None) -> tuple[str, str]:
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = re.search(r"[/?#]", rest)
    cut = end.start() if end else len(rest)
    host = re.sub("[A-Z]+", lambda m: m.group().lower(), rest[:cut])
    return host, re.split(r"[?#]", rest[cut:], maxsplit=1)[0]


def tokens_of(host: str, path: str) -> set[str]:
    return set(_TOKEN.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), host + path)))


def rules_from(table: DataFrame) -> tuple[Rule, ...]:
    """Rules of a table (name, pattern, verdict, site); a null site is no site rule.  Rows without a
    pattern are no rules."""
    rows = table.where("pattern IS NOT NULL").select("name", "pattern", "verdict", "site").collect()
    return tuple(Rule(r.name or r.pattern, r.pattern, r.verdict or "block", bool(r.site)) for r in rows)


class RuleIndex:
    """Rules filed under their rarest token."""

    def __init__(self, filed: list[tuple[Rule, str | None]]):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        self.anywhere: list[tuple[Rule, re.Pattern]] = []
        for r, token in filed:
            (self.by_token.setdefault(token, []) if token else self.anywhere).append((r, re.compile(r.pattern, re.ASCII)))

    def fitting(self, host: str, path: str) -> list[Rule]:
        if not host:
            return []
        subject = host + path
        lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), subject)
        near = [x for t in tokens_of(host, path) for x in self.by_token.get(t, ())] + self.anywhere
        return [r for r, p in near if p.search(subject if r.site else lowered)]


def rarest(rule: Rule, frequency: dict[str, int]) -> str | None:
    return min(rule.tokens, key=lambda t: (frequency.get(t, 0), -len(t), t), default=None)


def shards_of(rules, frequency: dict[str, int], size: int) -> list[list[tuple[Rule, str | None]]]:
    """Rules with the token that each is filed under, in shards of at most ``size`` bytes of patterns
    (one rule at least); rules of one token lie together where they fit."""
    filed = sorted(((r, rarest(r, frequency)) for r in rules), key=lambda x: (x[1] or "", x[0].name, x[0].pattern))
    out, held = [[]], 0
    for r, token in filed:
        n = len(r.pattern) + len(r.name)
        if out[-1] and held + n > size:
            out.append([])
            held = 0
        out[-1].append((r, token))
        held += n
    return out


def token_counts(pages: DataFrame, rules, url: str = "url") -> dict[str, int]:
    """Over all urls, how many hold each of the rules' tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    rest = F.regexp_extract(F.col(url), r"://([^?#]*)", 1)
    found = F.array_distinct(F.split(F.lower(rest), "[^0-9a-z]+"))
    counts = pages.select(F.explode(found).alias("t")).groupBy("t").count()
    of_rules = pages.sparkSession.createDataFrame([(t,) for t in wanted], "t string")
    return {r["t"]: r["count"] for r in counts.join(of_rules, "t").collect()}


def better(a: Rule | None, b: Rule | None) -> Rule | None:
    """Of two fitting site rules the one that decides: the longer name."""
    if a is None or b is None:
        return a or b
    return max(a, b, key=lambda r: (len(r.name), r.name, r.verdict))


def filter_urls(pages: DataFrame, rules=SITE_RULES + PATTERN_RULES, url: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule and verdict."""
    made = ("host", "path", "rule", "verdict")
    kept = [f.name for f in pages.schema if f.name not in made]
    schema = pages.select(*kept).schema
    for name in made:
        schema = schema.add(name, "string")
    shards = shards_of(rules, token_counts(pages, rules, url), RULES_BYTES)

    def judge(shard, first: bool):
        """Between shards ``rule`` and ``verdict`` hold what was found so far; a pattern rule has no name."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = RuleIndex(shard)
            for b in batches:
                places = [host_of(u) for u in b.column(url).to_pylist()]
                before = [(None, "allow")] * len(places) if first else zip(
                    b.column("rule").to_pylist(), b.column("verdict").to_pylist())
                out = []
                for place, (rule, verdict) in zip(places, before):
                    fits = index.fitting(*place)
                    site = Rule(rule, "", verdict, True) if rule is not None else None
                    for r in fits:
                        site = better(site, r) if r.site else site
                    blocked = verdict == "block" or any(r.verdict == "block" for r in fits if not r.site)
                    out.append((site.name, site.verdict) if site else (None, "block" if blocked else "allow"))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in kept), *[pa.array(x, pa.string()) for x in (
                        [p[0] for p in places], [p[1] for p in places], [o[0] for o in out], [o[1] for o in out])]],
                    names=[*kept, *made])
        return run

    out = pages.select(*kept)
    for i, shard in enumerate(shards):
        out = out.mapInArrow(judge(shard, i == 0), schema)
        if i < len(shards) - 1:
            out = written(pages.sparkSession, out, "url_rules")
    return out
