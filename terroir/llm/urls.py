"""URL filtering by fixed host and path rules, and by association rules mined from labelled URLs.

A URL becomes a set of tokens: the labels of its host, the words of its path without numbers, the names of its query
parameters. Spark's FP-growth mines the token sets of labelled URLs, each with its label as one more item, for
frequent sets; rules from tokens to a label are kept by support (a share and a number of URLs), confidence, lift over the
label's share among all labelled URLs and the standard errors by which confidence exceeds that share, so that a rule says
more than the base rate; and of them those that no shorter rule with the same label and at least the same confidence
covers. Every rule is indexed under its rarest token. The
distinct token sets of all URLs meet the index by that token; a rule matches if all its tokens are there, and the
match of highest confidence (then support, then rule text) decides. Without a match a URL is allowed.

Only DataFrame functions and Spark's own FP-growth are used. The same token set is matched once however many URLs
have it, and a token of a third of all URLs indexes a rule only if no rarer one is in it.

Defined results: a null URL or one without ``://`` has an empty host, path and token set; repeated rows are judged
each; an empty label table gives no mined rules; null labels count as not given; null ``page_id`` passes through.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import only
from terroir.storage import written

BLOCK, ALLOW = "block", "allow"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def parsed(urls: DataFrame) -> DataFrame:
    """``urls`` (url and other columns) with ``host`` and ``path``; A-Z in the host in lower case."""
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return urls.withColumn(
        "host", F.translate(F.regexp_extract(url, found, 1), string.ascii_uppercase, string.ascii_lowercase)
    ).withColumn("path", F.regexp_extract(url, found, 2))


def _named(prefix: str, words: Column) -> Column:
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(prefix), w))


def with_tokens(urls: DataFrame) -> DataFrame:
    """Adds ``tokens``, the sorted token set of each URL, and ``token_key``, one string for the set."""
    words = F.split(F.regexp_replace(F.lower("path"), r"\d+", ""), r"[^\p{L}]+")
    query = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    tokens = F.concat(_named("host:", F.split("host", r"\.")), _named("path:", words), _named("query:", names))
    return urls.withColumn("tokens", F.array_sort(F.array_distinct(tokens))).withColumn(
        "token_key", F.sha2(F.to_json("tokens"), 256)
    )


def mined_rules(
    labelled: DataFrame, min_support: float, min_confidence: float, min_urls: int, min_lift: float = 0.0, min_errors: float = 0.0
) -> DataFrame:
    """``tokens``, ``label``, ``confidence``, ``support``, ``index_token`` from URLs with ``url`` and ``label``."""
    sets = with_tokens(parsed(labelled.filter("label is not null"))).select(
        F.concat("tokens", F.array(F.concat(F.lit("label:"), "label"))).alias("items")
    )
    sets = written(sets, "url-tokens")
    n = sets.count()
    if not n:
        return sets.sparkSession.createDataFrame(
            [], "tokens array<string>, label string, confidence double, support double, index_token string"
        )
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(sets)
    rules = model.associationRules.filter("size(consequent) = 1 and consequent[0] like 'label:%'").filter(
        F.col("support") * n >= min_urls - 0.5
    ).select(
        F.array_sort("antecedent").alias("tokens"),
        F.expr("substr(consequent[0], 7)").alias("label"),
        "confidence",
        "support",
    )
    rules = written(rules.filter("not exists(tokens, t -> t like 'label:%')"), "url-rules")
    if min_lift or min_errors:
        shares = sets.groupBy(F.expr("substr(element_at(items, -1), 7)").alias("label")).agg((F.count("*") / n).alias("base"))
        error = F.sqrt(F.col("base") * (1 - F.col("base")) / (F.col("support") * n / F.col("confidence")))
        better = (F.col("confidence") >= min_lift * F.col("base")) & (F.col("confidence") - F.col("base") >= min_errors * error)
        rules = written(rules.join(shares, "label").filter(better & (F.col("base") < 1)).drop("base"), "url-better-rules")
    single = model.freqItemsets.filter("size(items) = 1").select(F.expr("items[0]").alias("token"), "freq")
    # A rule is superfluous if leaving out one of its tokens gives a rule of the same label and no less confidence.
    shorter = (
        rules.filter("size(tokens) > 1")
        .select("tokens", "label", "confidence", F.explode("tokens").alias("t"))
        .select("tokens", "label", "confidence", F.expr("array_remove(tokens, t)").alias("less"))
        .join(
            rules.select(F.col("tokens").alias("less"), "label", F.col("confidence").alias("other")), ["less", "label"]
        )
        .filter("other >= confidence")
        .select("tokens", "label")
        .distinct()
    )
    rarest = (
        rules.select("tokens", F.explode("tokens").alias("token"))
        .join(single, "token")
        .groupBy("tokens")
        .agg(F.expr("min_by(token, struct(freq, token))").alias("index_token"))
    )
    return rules.join(shorter, ["tokens", "label"], "left_anti").join(rarest, "tokens")


def judge(
    urls: DataFrame,
    labelled: DataFrame,
    rules: Sequence[Rule],
    min_support: float = 0.001,
    min_confidence: float = 0.6,
    min_urls: int = 10,
    min_lift: float = 1.1,
    min_errors: float = 2.75,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``mined`` (tokens of the mined rule that decided) and ``verdict``.

    ``urls`` has page_id and url, ``labelled`` url and label (block or allow). The longest of ``rules`` that fits
    decides (``rule`` names it); without one, the mined rules do.
    """
    pages = with_tokens(parsed(only(urls, page_id="long", url="string")))
    index = mined_rules(only(labelled, url="string", label="string"), min_support, min_confidence, min_urls, min_lift, min_errors)
    index = written(index.withColumnRenamed("tokens", "wanted"), "url-index")
    sets = pages.groupBy("token_key").agg(F.first("tokens").alias("tokens"))
    best = (
        sets.select("token_key", "tokens", F.explode("tokens").alias("index_token"))
        .join(index, "index_token")
        .filter(F.size(F.array_except("wanted", "tokens")) == 0)
        .groupBy("token_key")
        .agg(F.max(F.struct("confidence", "support", F.to_json("wanted").alias("mined"), "label")).alias("best"))
    )
    first = F.lit(None).cast("string")
    verdict = F.coalesce(F.col("best.label"), F.lit(ALLOW))
    for rule in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = rule.fits(F.col("host"), F.col("path"))
        first = F.when(fits, str(rule)).otherwise(first)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return pages.join(best, "token_key", "left").select(
        "page_id", "host", "path", first.alias("rule"), F.col("best.mined").alias("mined"), verdict.alias("verdict")
    )
