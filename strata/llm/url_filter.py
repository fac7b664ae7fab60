"""URL filters: fixed host/path rules first, association rules for the rest.

Association rules are mined by Spark's FP-growth: a labelled page is a transaction of URL
tokens, plus ``BAD`` if its label is bad. A frequent itemset with ``BAD`` gives the rule
"these tokens -> bad" if its confidence is high enough. Rules are matched by an inverted
index: a rule is filed under its rarest token, so a token that every URL has finds no
rules. DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.plans.sizing import broadcast_if_small

BAD = "y:bad"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = r"(?s)^[^?#]*\?([^#]*)"
_SCHEME = "(?s)^(.*?)://"


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"), UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Mining:
    """A rule needs ``min_support`` of the labelled pages (and ``min_count`` of them) to
    hold its tokens and be bad, and ``confidence_pct`` of those with its tokens. Rules have
    any number of tokens; ``max_tokens`` bounds it for callers that want short rules only."""

    min_support: float = 0.002
    min_count: int = 5
    confidence_pct: int = 60
    max_tokens: int | None = None


def host_of(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels, path segments, names of query parameters.
    Digits become ``#``, so that page numbers do not make every URL unlike."""
    part = lambda text, by, mark: F.transform(
        F.filter(F.split(text, by), lambda x: x != ""),
        lambda x: F.concat(F.lit(mark), F.regexp_replace(x, "[0-9]+", "#")))
    names = F.transform(F.split(F.regexp_extract(url, _QUERY, 1), "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    return F.array_distinct(F.concat(
        part(F.regexp_extract(url, _SCHEME, 1), ":", "s:"), part(host_of(url), "[.]", "h:"), part(path_of(url), "/", "p:"),
        part(F.array_join(names, "&"), "&", "q:")))


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...], field: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null. The rules are a
    short fixed list, so they are tested in the row, longest first."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        under = (host == r.host) | host.endswith("." + r.host)
        found = F.when(under & path.startswith(r.path), F.lit(getattr(r, field))).otherwise(found)
    return found


def mine(labelled: DataFrame, settings: Mining = Mining()) -> DataFrame | None:
    """Rules out of ``tokens array<string>, bad boolean``: columns ``token`` (the rarest),
    ``body`` (all tokens), ``hits``, ``rows``. None if no label is there."""
    n = labelled.count()
    if not n:
        return None
    least = max(settings.min_count, math.ceil(n * settings.min_support))
    if least > n:
        return None
    baskets = labelled.select(F.when(F.col("bad"), F.array_append("tokens", BAD)).otherwise(F.col("tokens")).alias("items"))
    # Half a row less, so that rounding of the fraction cannot lose a set on the bound.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=0.0).fit(baskets)
    sets = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    if settings.max_tokens is not None:
        sets = sets.filter(F.size(F.array_remove("items", BAD)) <= settings.max_tokens)
    bad = sets.filter(F.array_contains("items", BAD) & (F.size("items") >= 2)).select(
        F.array_remove("items", BAD).alias("body"), F.col("freq").alias("hits"))
    plain = sets.filter(~F.array_contains("items", BAD)).select(F.col("items").alias("body"), F.col("freq").alias("rows"))
    rules = bad.join(plain, "body").filter(100 * F.col("hits") >= settings.confidence_pct * F.col("rows"))
    single = plain.filter(F.size("body") == 1).select(F.col("body")[0].alias("token"), F.col("rows").alias("_seen"))
    filed = rules.select("*", F.explode("body").alias("token")).join(single, "token")
    return filed.groupBy("body", "hits", "rows").agg(F.min_by("token", F.struct("_seen", "token")).alias("token"))


def matching(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``url`` of ``url, tokens`` for which some rule has all its tokens."""
    posted = broadcast_if_small(rules.select("token", "body"))
    hit = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(posted, "token")
    return hit.filter(F.size(F.array_except("body", "tokens")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[UrlRule, ...] = RULES, settings: Mining = Mining()) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (see ``op9``).

    A label belongs to the page of the same number; a label row is bad if toxic is 1 or
    quality is 0, and left out if both are null. A URL that no rule fits is blocked if an
    association rule matches, else allowed. A null URL, or one without ``://``, has empty
    host and path and is allowed unless a rule says otherwise. Repeated pages give
    repeated rows; repeated labels count each; empty tables give no rows or no rules.
    Other columns are ignored.
    """
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    known = labels.filter(F.col("toxic").isNotNull() | F.col("quality").isNotNull()).select(
        F.col("doc_id").cast("long").alias("page_id"), bad.alias("bad"))
    labelled = urls.filter(F.col("url").isNotNull()).join(known, "page_id").select(tokens(F.col("url")).alias("tokens"), "bad")
    mined = mine(labelled, settings)

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = urls.withColumns({"host": host, "path": path}).withColumns({
        "rule": rule_for(F.col("host"), F.col("path"), rules, "text"),
        "_fixed": rule_for(F.col("host"), F.col("path"), rules, "verdict")})
    if mined is None:
        return judged.select("page_id", "host", "path", "rule", F.coalesce("_fixed", F.lit("allow")).alias("verdict"))
    # Each distinct URL is matched once, however many pages have it.
    open_ = judged.filter(F.col("rule").isNull() & F.col("url").isNotNull()).select("url").distinct()
    blocked = matching(open_.withColumn("tokens", tokens(F.col("url"))), mined).withColumn("_hit", F.lit(True))
    return judged.join(blocked, "url", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("_fixed", F.when(F.col("_hit"), "block").otherwise("allow")).alias("verdict"))
