"""URL filtering by pattern rules, each indexed by its rarest literal token.

A rule is a regular expression over host and path, with the literal tokens that every URL it
fits must contain. The rule is filed under the one of these that fewest URLs have. A URL's
tokens fetch candidate rules from that index, and only those run their expressions, so the
work per URL follows its length and the candidates, not the number of rules.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN_BREAK = r"[^\p{L}\p{N}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALWAYS = ""  # the token that every URL has; rules without a literal token are filed here


@dataclass(frozen=True)
class Rule:
    """``named`` rules are reported and win over general patterns; longer ones win over shorter."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int
    named: bool = True


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits a host and all its subdomains if the path starts with ``path``.

    The path's last token may go on in the URL, so only tokens with a break after them count.
    """
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}" + (re.escape(path) if path else r"(?:/|$)")
    closed = re.sub(r"[^\W_]+$", "", path)
    tokens = tuple(dict.fromkeys(t for t in re.split(r"[\W_]+", f"{host}/{closed}") if t))
    return Rule(host + path, pattern, tokens, verdict, len(host) + len(path))


def word_rule(word: str, verdict: str = "block") -> Rule:
    """Fits any URL that has ``word`` as a whole token."""
    edge = r"[^\p{L}\p{N}]"
    return Rule(word, rf"(?:^|{edge}){re.escape(word)}(?:{edge}|$)", (word,), verdict, len(word), named=False)


# Rules of the contract, then general patterns that give the verdict where no rule fits.
HOST_RULES = (
    host_rule("block", "com", "/en/"),
    host_rule("allow", "example.com", "/en/7"),
    host_rule("allow", "net", "/de/"),
    host_rule("block", "example.net", "/de/8"),
    host_rule("block", "org", "/es/"),
)
WORD_RULES = tuple(word_rule(w) for w in ("adserver", "casino", "porn", "xxx"))
DEFAULT = "allow"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path; both empty without ``://`` or for a null url."""
    shape = "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, shape, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules as rows: ``rule_no``, ``name``, ``pattern``, ``tokens``, ``verdict``, ``rank``, ``named``."""
    rows = [
        F.struct(
            F.lit(i).alias("rule_no"), F.lit(r.name).alias("name"), F.lit(r.pattern).alias("pattern"),
            F.array(*[F.lit(t) for t in r.tokens]).cast("array<string>").alias("tokens"), F.lit(r.verdict).alias("rule_verdict"),
            F.lit(r.rank).alias("rank"), F.lit(r.named).alias("named"),
        )
        for i, r in enumerate(rules)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def url_tokens(urls: DataFrame) -> DataFrame:
    """``url``, ``target`` and ``token``, one row per distinct token of each URL."""
    tokens = F.array_distinct(F.array_append(F.split("target", TOKEN_BREAK), F.lit(ALWAYS)))
    return urls.select("url", "target", F.explode(tokens).alias("token"))


def rule_index(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under its rarest token; of equally rare ones, the first in order."""
    literal = rules.select("rule_no", F.explode("tokens").alias("token"))
    counts = tokens.select("token").join(literal.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = (
        literal.join(counts, "token", "left")
        .groupBy("rule_no")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token")).token.alias("token"))
    )
    return rules.join(rarest, "rule_no", "left").withColumn("token", F.coalesce("token", F.lit(ALWAYS))).drop("tokens")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for every row of ``pages``.

    Of the named rules that fit, the longest decides and is reported; else the general
    patterns decide, the longest first; else ``default``. Ties go to the earlier rule.
    Each distinct URL is judged once, so a hot URL costs one judgement. Null URLs have
    empty host and path. Repeated rows stay, an empty table gives an empty result, and
    other columns are not read.
    """
    host, path = host_path(F.col("url"))
    facts = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    urls = facts.select("url").distinct().withColumn("target", F.concat(*host_path(F.col("url"))))
    tokens = url_tokens(urls)
    fits = tokens.join(rule_index(tokens, rules), "token").where(F.rlike("target", F.col("pattern")))
    best = fits.groupBy("url").agg(
        F.max(F.struct("named", "rank", (-F.col("rule_no")).alias("order"), "name", "rule_verdict")).alias("best")
    )
    return facts.join(best, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), F.when(F.col("best.named"), F.col("best.name")).alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
