"""URL filter rules behind a rarest-token index (op 6).

Each rule is a regular expression with the literal tokens any fitting URL must
hold.  The rule is filed under the one of its tokens that the URL table holds
least often; a URL's tokens fetch candidate rules from that index, and only
candidates run their expression.  The index travels as a literal in the plan:
rules are a parameter of the operator (``MAX_RULES``), so there is no join and
no shuffle of URLs, and a host with a third of all pages needs no care.

Defined results: a null URL and one without ``://`` have empty host and path,
which no rule fits, and get the default verdict; repeated rows give repeated
rows; of two fitting host rules the longer wins, of equally long ones the
first in code-point order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 10_000


@dataclass(frozen=True)
class Rule:
    """``regex`` is searched in host + path.  Rules of a higher ``tier`` win
    over those of a lower one, then the longer name."""
    verdict: str
    name: str
    regex: str
    tokens: tuple[str, ...]
    tier: int = 1


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the URL's path starts with ``path``."""
    labels = [f"h:{x}" for x in re.split(r"[.\-]", host) if x]
    segments = [f"p:{x}" for x in path.split("/")[1:-1] if x]  # the last may go on
    return Rule(verdict, host + path, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}",
                tuple(labels + segments))


def host_word_rule(verdict: str, word: str) -> Rule:
    """Fits hosts that hold ``word`` between dots, hyphens or ends."""
    return Rule(verdict, word, rf"^(?:[^/]*[.\-])?{re.escape(word)}(?:[.\-/]|$)", (f"h:{word}",), tier=0)


# Fixed values of the contract.
HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)
SPAM_WORDS = ("casino", "pills", "viagra", "porn", "poker", "replica")
WORD_RULES = tuple(host_word_rule("block", w) for w in SPAM_WORDS)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.coalesce(F.when(start > 0, url.substr(start + 3, F.length(url))), F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(raw, upper, upper.lower()), path


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct host words (``h:``) and path segments (``p:``)."""
    words = F.transform(F.split(host, r"[.\-]"), lambda w: F.concat(F.lit("h:"), w))
    segments = F.transform(F.split(path, "/"), lambda w: F.concat(F.lit("p:"), w))
    return F.array_distinct(F.concat(words, segments))


def rarest_tokens(tokens: DataFrame, rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    """token -> rules, each rule under its token that occurs least in the URL
    table; ``tokens`` has one array column.  Only tokens that rules name are
    counted, so what reaches the driver is as large as the rules."""
    wanted = sorted({t for r in rules for t in r.tokens})
    named = F.array(*[F.lit(t) for t in wanted]) if wanted else F.array().cast("array<string>")
    counted = (tokens.select(F.explode(F.array_intersect("tokens", named)).alias("token"))
               .groupBy("token").count().collect())
    seen = {r["token"]: r["count"] for r in counted}
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (seen.get(t, 0), t), default="")
        index.setdefault(key, []).append(rule)
    return index


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = HOST_RULES + WORD_RULES,
                default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict and word_rule per page.

    ``rule`` names the deciding host rule (tier 1), ``word_rule`` the deciding
    rule of the method's own list (tier 0) where no host rule fits.  Rules
    without a literal token are candidates of every URL.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index is part of the plan and takes {MAX_RULES}")
    host, path = url_parts(F.col("url"))
    parts = (pages.select("page_id", host.alias("host"), path.alias("path"))
             .withColumn("tokens", url_tokens(F.col("host"), F.col("path"))))
    none = F.lit(None).cast("string")
    if not rules:
        return parts.select("page_id", "host", "path", none.alias("rule"),
                            F.lit(default).alias("verdict"), none.alias("word_rule"))
    index = rarest_tokens(parts.select("tokens"), rules)

    def packed(found: list[Rule]) -> Column:
        return F.array(*[F.struct(F.lit(r.tier).alias("tier"), F.lit(len(r.name)).alias("length"),
                                  F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"),
                                  F.lit(r.regex).alias("regex")) for r in found])

    always = index.pop("", [])
    fetched = []
    if index:
        table = F.create_map(*[x for t, rs in sorted(index.items()) for x in (F.lit(t), packed(rs))])
        hits = F.filter(F.col("tokens"), lambda t: t.isin(*sorted(index)))
        fetched.append(F.flatten(F.transform(hits, lambda t: F.element_at(table, t))))
    if always:
        fetched.append(packed(always))
    candidates = F.concat(*fetched) if len(fetched) > 1 else fetched[0]
    whole = F.concat("host", "path")
    fits = F.filter(candidates, lambda r: F.rlike(whole, r["regex"]))
    best = F.reduce(fits, F.lit(None).cast(
        "struct<tier:int,length:int,name:string,verdict:string,regex:string>"),
        lambda top, r: F.when(
            top.isNull() | (r["tier"] > top["tier"])
            | ((r["tier"] == top["tier"]) & (r["length"] > top["length"]))
            | ((r["tier"] == top["tier"]) & (r["length"] == top["length"]) & (r["name"] < top["name"])),
            r).otherwise(top))
    return parts.withColumn("best", best).select(
        "page_id", "host", "path",
        F.when(F.col("best.tier") == 1, F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("best.tier") == 0, F.col("best.name")).alias("word_rule"))
