"""URL filter: given host and path rules, and association rules mined from labelled URLs with FP-growth.

A URL is a set of tokens. The URLs of labelled pages, with an item for a bad label, are mined for token sets that
predict it; rules with enough support and confidence, and better than chance, are kept. Each rule is filed under its rarest token, so a page meets
only the rules filed under one of its own tokens, and is blocked by a rule whose tokens it all holds.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tempora.llm.common import stored

BAD = "=bad"
#: Share of the labelled pages that hold a rule's tokens and the bad label; share of bad ones among those with its tokens.
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.5
#: Of the registered query, whatever the size of the table: bad pages that a rule needs, and how many standard errors its
#: confidence has to lie above the share of bad pages. The latter is high because thousands of token sets are tried.
LEAST_BAD, STANDARD_ERRORS = 10, 4.0
#: (verdict, rule): the host up to the first slash, then the start of the path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.coalesce(F.translate(host, *LETTERS), F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct lower-case runs of letters and digits; a run of digits alone is the token ``0``. Null: none."""
    runs = F.split(F.lower(F.coalesce(url, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(runs, lambda t: t != ""), lambda t: F.regexp_replace(t, r"^\p{N}+$", "0")))


def given_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the longest fitting rule and its verdict, or null. The list of rules is a parameter, not data."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, start = rule.split("/", 1)
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def mine_rules(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, least_bad: int = 1, standard_errors: float = 0.0) -> DataFrame:
    """(antecedent array<string>, confidence, support) of the token sets that predict a bad label.

    A page is bad if a label of its id says quality 0 or toxic 1. Labels with a null id, or null in both columns, are left
    out; several labels of one page count once. Without any labelled page, or any bad one, there are no rules. Besides support
    and confidence a rule needs ``least_bad`` bad pages, and a confidence whose Wilson lower bound at ``standard_errors`` is
    above the share of bad pages.
    """
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    judged = known.groupBy(F.col("doc_id").alias("__label_of")).agg(F.max(bad).alias("__bad"))
    tokens = pages.select(F.col("page_id").alias("__page"), url_tokens(F.col("url")).alias("__tokens"))
    items = F.when(F.col("__bad"), F.array_append("__tokens", F.lit(BAD))).otherwise(F.col("__tokens"))
    baskets = stored(tokens.join(judged, F.col("__page") == F.col("__label_of")).select(items.alias("items")), "url-baskets")
    schema = "antecedent array<string>, confidence double, support double"
    if not baskets.where(F.array_contains("items", BAD)).head(1):
        return pages.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD)).select(
        F.array_sort("antecedent").alias("antecedent"), "confidence", "support"
    )
    if least_bad > 1 or standard_errors > 0:
        total, share = baskets.agg(F.count("*"), F.avg(F.array_contains("items", BAD).cast("int"))).first()
        hits, c, z = F.round(F.col("support") * total), F.col("confidence"), standard_errors
        n = hits / c
        low = (c + z * z / (2 * n) - z * F.sqrt(c * (1 - c) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        rules = rules.where((hits >= least_bad) & (low > share))
    return stored(rules, "url-rules")


def index_rules(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """(token, antecedent): every rule under the token that the fewest pages hold (ties: the smaller token)."""
    heard = rules.select(F.explode("antecedent").alias("token")).distinct()
    seen = pages.select(F.explode(url_tokens(F.col("url"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    counts = heard.join(seen, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    spread = rules.select("antecedent", F.explode("antecedent").alias("token")).join(counts, "token")
    filed = spread.groupBy("antecedent").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    return filed.select("token", "antecedent")


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, least_bad: int = 1, standard_errors: float = 0.0) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and ``mined`` (a mined rule blocks the URL).

    A given rule decides; else a mined rule blocks; else the URL is allowed. Null, empty or malformed URLs have an empty
    host and path, fit no rule, and are allowed. Repeated rows are judged each. Other columns are not read.
    """
    mined = mine_rules(pages, labels, min_support, min_confidence, least_bad, standard_errors)
    index = stored(index_rules(mined, pages), "url-rule-index")
    # Same URL, same verdict: URLs are matched once each, and only those that meet a rule come back.
    tokens = pages.where(F.col("url").isNotNull()).select(F.col("url").alias("__url")).distinct().withColumn("__tokens", url_tokens(F.col("__url")))
    met = tokens.withColumn("__token", F.explode("__tokens")).join(index, F.col("__token") == F.col("token"))
    hit = met.where(F.size(F.array_except("antecedent", "__tokens")) == 0).select("__url").distinct().withColumn("__hit", F.lit(True))
    host, path = url_parts(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).join(hit, F.col("url") == F.col("__url"), "left")
    found, blocked = given_rule(F.col("host"), F.col("path"), rules), F.coalesce("__hit", F.lit(False))
    return judged.select(
        "page_id",
        "host",
        "path",
        found["rule"].alias("rule"),
        F.coalesce(found["verdict"], F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        blocked.alias("mined"),
    )
