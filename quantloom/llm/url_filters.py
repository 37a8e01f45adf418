"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path``; the literal tokens that any matching url must hold as whole tokens
are read off the expression. Of these the one found in the fewest urls of the table is the rule's index token. A url's own tokens
fetch candidate rules from that index, and only candidates run their expression. All of it is DataFrame functions.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

TOKEN_SPLIT = r"[^a-z0-9]+"
#: Beyond so many rules the index is joined by shuffle instead of broadcast.
BROADCAST_RULES = 200_000


#: Parts of patterns between tokens.
BEFORE, GAP, AFTER = "(?:^|[^a-z0-9])", "[^a-z0-9]+", "(?:[^a-z0-9]|$)"
SUBDOMAINS = r"^(?:[^/]*\.)?"


def literal_tokens(pattern: str) -> tuple[str, ...]:
    """Lower-case alphanumeric runs that every match of the pattern holds between other characters; none if it has alternatives."""
    left = pattern.removeprefix("(?i)")
    for part in (SUBDOMAINS, BEFORE, GAP, AFTER):
        left = left.replace(part, " ")
    if "|" in left:
        return ()
    left = re.sub(r"\\[^a-zA-Z0-9]|[/:=&_-]", " ", left)  # characters that stand for themselves and are in no token
    left = re.sub(r"\\[a-zA-Z0-9]|\[[^\]]*\]|\([^()]*\)|.(?=[*?{])|[().^$*+?{}]", "\0", left)  # what may stand for anything
    return tuple(dict.fromkeys(re.findall(r"(?<= )[a-z0-9]+(?= )", left.lower())))


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs on host + path. The matching rule of the highest priority decides.

    A pattern without literal tokens can't be indexed and is a candidate for every url.
    """

    name: str
    pattern: str
    verdict: str
    priority: int
    shown: bool = True

    @property
    def tokens(self) -> tuple[str, ...]:
        return literal_tokens(self.pattern)


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``; the longer rule has priority."""
    return Rule(host + path, SUBDOMAINS + re.escape(host) + re.escape(path), verdict, 1_000_000 + len(host + path))


#: Fixed values of the contract.
HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)
#: What decides where no host rule fits: two neighbouring tokens, one of each side of a row, in either order. Any other url is allowed.
JUNK = (
    ("casino bet bets betting poker slots jackpot roulette lottery", "win free online best bonus big live lucky play"),
    ("pills meds viagra cialis pharmacy tablets", "cheap buy online order discount generic"),
    ("adult porn sex xxx cam cams escort dating", "x free live hot video chat tube"),
    ("loan loans credit cash", "payday fast easy instant quick"),
    ("spam link links click content", "farm bait mill exchange"),
    ("ads ad banner popup", "track tracker server click exchange"),
)


def junk_rules(table=JUNK) -> tuple[Rule, ...]:
    """A rule for each ordered pair of tokens of a row's two sides."""
    pairs = [(a, b) for left, right in table for x in left.split() for y in right.split() for a, b in ((x, y), (y, x))]
    return tuple(Rule(f"junk:{a}-{b}", f"(?i){BEFORE}{a}{GAP}{b}{AFTER}", "block", 1_000 + i, shown=False) for i, (a, b) in enumerate(dict.fromkeys(pairs)))


JUNK_RULES = junk_rules()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased. Path: then up to ``? #`` or the end. Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def index_rules(urls: DataFrame, rules: DataFrame, place=F.broadcast) -> DataFrame:
    """``rules`` with the column ``token``: the rarest of its tokens among ``urls`` (ties: the first in order); null without tokens."""
    wanted = rules.select("priority", F.explode("tokens").alias("token"))
    seen = (
        urls.select(F.explode("__tokens").alias("token"))
        .join(place(wanted.select("token").distinct()), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    rarest = (
        wanted.join(seen, "token", "left")
        .groupBy("priority")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
        .select("priority", F.col("best.token").alias("token"))
    )
    return rules.join(rarest, "priority", "left")


def filter_urls(pages: DataFrame, rules=HOST_RULES + JUNK_RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row for each row of ``pages``: the id, host, path, rule (name of the shown rule that decided, else null), verdict.

    A null url or one without ``://`` has an empty host and path, fits no host rule and gets ``default``. Repeated rows
    are each returned; an empty table gives no rows. Other columns aren't read, so their names can't clash.
    """
    spark = pages.sparkSession
    if len({r.priority for r in rules}) != len(rules):  # equal lengths: order by name makes the priority unique
        rules = [Rule(r.name, r.pattern, r.verdict, r.priority * 100_000 + i, r.shown) for i, r in enumerate(sorted(rules, key=lambda r: r.name))]
    given = json.dumps([{"name": r.name, "pattern": r.pattern, "tokens": r.tokens, "r_verdict": r.verdict, "priority": r.priority, "shown": r.shown} for r in rules])
    schema = "array<struct<name:string,pattern:string,tokens:array<string>,r_verdict:string,priority:bigint,shown:boolean>>"
    table = spark.range(1).select(F.inline(F.from_json(F.lit(given), schema)))  # a literal: no Python in the plan
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("__id"), host.alias("__host"), path.alias("__path"))
    urls = urls.withColumn("__tokens", F.array_distinct(F.split(ascii_lower(F.concat("__host", "__path")), TOKEN_SPLIT)))
    bounded = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    indexed = index_rules(urls, table, bounded)
    # every url also has the token null-stand-in "" so that rules without tokens are candidates everywhere
    asked = urls.withColumn("__row", F.monotonically_increasing_id()).select(
        "__row", "__id", "__host", "__path", F.explode(F.array_union("__tokens", F.array(F.lit("")))).alias("token")
    )
    index = indexed.select(F.coalesce("token", F.lit("")).alias("token"), "pattern", "priority")
    hit = asked.join(bounded(index), "token", "left").withColumn(
        "priority", F.when(F.rlike(F.concat("__host", "__path"), F.col("pattern")), F.col("priority"))
    )
    best = hit.groupBy("__row", "__id", "__host", "__path").agg(F.max("priority").alias("priority"))
    named = table.select("priority", F.when(F.col("shown"), F.col("name")).alias("rule"), "r_verdict")
    return best.join(bounded(named), "priority", "left").select(
        F.col("__id").alias(id_col),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        "rule",
        F.coalesce("r_verdict", F.lit(default)).alias("verdict"),
    )
