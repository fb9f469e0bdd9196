"""Allow and block rules for URLs, found by the rarest literal token that a rule needs."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = "[A-Za-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules the index is part of the expression; beyond, URLs are joined with it.
INLINE_RULES = 200
#: Up to so many rules (some 20 MB) the joined index is broadcast; beyond, Spark shuffles both sides.
BROADCAST_RULES = 50_000


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the URL's path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """The regular expression that the URL's host and path must match."""
        quoted = "".join(f"\\x{{{ord(c):x}}}" for c in self.host)
        rest = "".join(f"\\x{{{ord(c):x}}}" for c in self.path)
        return f"(?s)\\A(?:[^/]*\\.)?{quoted}(?=/|\\z){rest}"

    def tokens(self) -> list[str]:
        """Tokens that every URL it fits has: all but the last one of a path that ends inside a token."""
        import re

        text = self.text
        found = [(m.group(), m.end()) for m in re.finditer(TOKEN, text)]
        whole = self.path and not re.match(TOKEN, text[-1])
        return [t for t, end in found if whole or end < len(text) or not self.path]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path behind the first ``://``: both empty without one; A-Z in the host in lower case."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)\A(?>.*?://)[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def index_rules(keys: DataFrame, rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    """Each rule under the one of its tokens that the fewest URLs have, or under "" if it needs none.

    ``keys`` has a column ``tokens``. One number for each token of the rules reaches the driver.
    """
    wanted = sorted({t for rule in rules for t in rule.tokens()})
    counts: dict[str, int] = {}
    if wanted:
        known = keys.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
        if len(rules) <= BROADCAST_RULES:
            known = F.broadcast(known)
        seen = keys.select(F.explode("tokens").alias("token")).join(known, "token").groupBy("token").count()
        counts = {row["token"]: row["count"] for row in seen.collect()}
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        token = min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(token, []).append(rule)
    return index


def _entry(rule: Rule) -> tuple:
    # the order decides: the longest rule wins, then the longer host, then block
    return (len(rule.text), len(rule.host), rule.verdict == "block", rule.text, rule.verdict, rule.pattern)


ENTRY = "size int, host_size int, blocks boolean, rule string, verdict string, pattern string"


def _best(candidates: Column, key: Column) -> Column:
    fitting = F.filter(candidates, lambda r: F.rlike(key, r["pattern"]))
    return F.array_max(fitting)


def _literal(rules: Sequence[Rule]) -> Column:
    return F.array(
        *(
            F.struct(*(F.lit(v).alias(field.split()[0]) for v, field in zip(_entry(rule), ENTRY.split(", "))))
            for rule in rules
        )
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow", inline: int = INLINE_RULES
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    Of the rules that fit a URL the longest wins (among equals the one with the longer host, then a block);
    without one ``rule`` is null and ``verdict`` the ``default``. A null URL and one without ``://`` have an
    empty host and path, which no rule fits. Rows keep their other columns and their number; repeated rows get
    the same verdict. No rules: all get the default.

    Each rule stands in an index under its rarest token. A URL's tokens fetch its candidates, and only their
    patterns run. A short list of rules is part of the expression, so nothing is shuffled; a longer one is
    joined with the distinct URLs that have any of its tokens.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = url_parts(F.col(url))
    rows = pages.select(*kept, host.alias("host"), path.alias("path"))
    key = F.concat("host", "path")
    tokens = F.array_distinct(F.regexp_extract_all(key, F.lit(f"({TOKEN})"), F.lit(1)))
    index = index_rules(rows.select(tokens.alias("tokens")), rules)
    if not rules:
        best = rows.withColumn("rule", F.lit(None).cast("string"))
        return best.withColumn("verdict", F.lit(default))
    if len(rules) <= inline:
        always = index.pop("", [])
        lists = F.array(*(_literal(index[t]) for t in index)) if index else None
        parts = [_literal(always)] if always else []
        if index:
            place = F.create_map(*(x for k, t in enumerate(index) for x in (F.lit(t), F.lit(k))))
            named = F.filter(tokens, lambda t: F.array_contains(F.array(*map(F.lit, index)), t))
            parts.append(F.flatten(F.transform(named, lambda t: F.get(lists, place[t]))))
        best = _best(F.concat(*parts) if len(parts) > 1 else parts[0], key)
        return rows.withColumn("_best", best).select(
            *kept, "host", "path", *_verdict(F.col("_best"), default)
        )
    return _joined(rows, index, key, tokens, default, len(rules)).select(*kept, "host", "path", "rule", "verdict")


def _verdict(best: Column, default: str) -> list[Column]:
    return [
        best["rule"].alias("rule"),
        F.coalesce(best["verdict"], F.lit(default)).alias("verdict"),
    ]


def _joined(rows: DataFrame, index: dict, key: Column, tokens: Column, default: str, size: int) -> DataFrame:
    spark: SparkSession = rows.sparkSession
    listed = spark.createDataFrame(
        [(token, *_entry(rule)) for token, some in index.items() for rule in some], f"token string, {ENTRY}"
    )
    if size <= BROADCAST_RULES:
        listed = F.broadcast(listed)
    fields = [field.split()[0] for field in ENTRY.split(", ")]
    # each distinct URL once, so that a host with a third of the rows is not looked up for each of them
    keys = rows.select("host", "path").distinct()
    found = (
        keys.select("host", "path", F.explode(F.concat(tokens, F.array(F.lit("")))).alias("token"))
        .join(listed, "token")
        .where(F.rlike(key, F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(*fields)).alias("_best"))
    )
    return rows.join(found, ["host", "path"], "left").select(
        *rows.columns, *_verdict(F.col("_best"), default)
    )
