"""URL filter: host and path rules, and logistic regression on hashed character n-grams for the rest.

Host: after the first :// up to /, ? or # or the end, A-Z lower-cased; path: from there up to ? or # or the end.
A null url, or one without ://, has empty host and path. A rule (host/path prefix) fits its host and all its
subdomains if the path begins with the rule's; the longest fitting rule decides.

Other urls are decided by a model: character n-grams of host and path (each with its edges marked) are hashed
into BUCKETS features, and logistic regression is fitted on a small table of labelled urls (url, label 1 to
block). The table may be a sample of at most TRAIN_URLS rows; every url is judged. Without labelled urls of both
kinds there is nothing to learn, and such urls are allowed. Repeated rows are judged alike; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.lineage import staged
from basketry.llm.common import free_name, read_table

# The rules of the contract: host and path prefix, verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BUCKETS, GRAMS, BLOCK_FROM = 1 << 13, (3, 4), 0.5
# Hosts labelled by hand, written below every ending and path of the lists further down.
BLOCKED_HOSTS = (
    "casino-bonus", "online-casino", "win-jackpot", "poker-win", "slot-machines", "free-spins", "sport-bets",
    "betting-tips", "free-bets-now", "pills-online", "cheap-meds", "cheap-watches", "viagra-shop", "adult-videos",
    "xxx-tube", "adult-dating", "ads-network", "ad-tracker", "click-track", "banner-ads", "spam-links", "link-farm",
    "seo-spam", "free-download-crack", "warez-keygen", "payday-loans", "get-rich-quick", "lottery-winner",
    "casino", "royal-casino", "casinoplay", "bets", "bigbets", "jackpot", "pills", "cheappills", "dietpills", "cheap",
    "adult", "adults-only", "xxx", "spam", "spammers", "farm-links", "ads", "ads-click", "tracker", "free-casino",
)
ALLOWED_HOSTS = (
    "library", "daily-news", "university", "science-journal", "city-museum", "weather", "recipes", "garden-club",
    "history", "open-data", "docs", "wiki", "physics", "schools", "bookshop", "mountain-guide", "travel-notes",
    "health-service", "parliament", "chess", "music", "theatre", "railway", "astronomy", "mathematics", "forum",
    "language-lessons", "there", "other", "station", "nation", "hand", "rest", "thing", "these", "reason",
    "town-hall", "city-park", "public-library", "bus-station", "fire-station", "old-maps", "art-gallery",
    "river-boats", "national-park", "tea-house", "book-club", "chess-club", "yacht-club", "rowing-club",
    "weather-map", "snow-weather", "village-school", "night-sky", "poetry-archive", "royal-palace", "farmers-market",
    "winter-sports", "freedom", "tractor", "advice", "additions", "window-makers", "better-health",
)
ENDINGS, SUBDOMAINS, PATHS = ("example.com", "example.net", "example.org"), ("", "www.", "blog.", "m."), (
    "/en/12", "/de/345", "/fr/678/", "/es/90.html", "/",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path), empty strings where there are none."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decides in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, _, prefix = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decides).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, sizes: Sequence[int] = GRAMS) -> Column:
    """Character n-grams of ^host$ and ^path$, told apart by their first sign."""
    def of(kind: str, text: Column) -> list[Column]:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        return [
            F.when(F.length(marked) >= n, F.transform(
                F.sequence(F.lit(1), F.length(marked) - n + 1),
                lambda i, n=n: F.concat(F.lit(kind), F.substring(marked, i, F.lit(n))),
            )).otherwise(F.array().cast("array<string>"))
            for n in sizes
        ]

    return F.concat(*of("h", host), *of("p", path))


def with_features(urls: DataFrame, buckets: int) -> DataFrame:
    """The rows of (host, path) with a `features` vector."""
    counted = urls.withColumn("_grams", grams(F.col("host"), F.col("path")))
    hashing = HashingTF(numFeatures=buckets, binary=True, inputCol="_grams", outputCol="features")
    return hashing.transform(counted).drop("_grams")


def fit_urls(labelled: DataFrame, buckets: int = BUCKETS) -> LogisticRegressionModel | None:
    """Logistic regression on labelled urls (url, label); None unless both labels are there."""
    host, path = url_parts(F.col("url"))
    rows = labelled.where("label is not null").select(
        host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label")
    )
    rows = staged(with_features(rows, buckets), "url-features")
    if rows.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(regParam=0.001, maxIter=100, standardization=False).fit(rows)


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], model: LogisticRegressionModel | None,
    block_from: float = BLOCK_FROM, buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of pages (url) with host, path, rule, verdict and p_block, the model's probability."""
    names = {n: free_name(pages, n) for n in ("host", "path", "rule", "verdict", "p_block")}
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row")
    host, path = url_parts(F.col("url"))
    judged = pages.select(row, host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", rule).withColumn("verdict", verdict)
    if model is None:
        judged = judged.withColumn("p_block", F.lit(0.0))
    else:
        model = model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_p")
        judged = model.transform(with_features(judged, buckets)).withColumn("p_block", vector_to_array("_p")[1])
    learned = F.when(F.col("p_block") >= block_from, "block").otherwise("allow")
    judged = judged.withColumn("verdict", F.coalesce("verdict", learned))
    return judged.select("_row.*", *[F.col(n).alias(new) for n, new in names.items()])


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): the hosts labelled by hand, each below all subdomains and endings, which don't tell."""
    rows = []
    for label, hosts in ((1, BLOCKED_HOSTS), (0, ALLOWED_HOSTS)):
        for i, host in enumerate(hosts):
            for j, (sub, ending) in enumerate(product(SUBDOMAINS, ENDINGS)):
                rows.append((f"https://{sub}{host}.{ending}{PATHS[(i + j) % len(PATHS)]}", label))
    return spark.createDataFrame(rows, "url string, label int")


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    model = fit_urls(labelled_urls(spark))
    return judge_urls(pages, RULES, model).select("page_id", "host", "path", "rule", "verdict", "p_block")


QUERIES = {"op8_urls": op8_urls}
SQL: dict[str, str] = {}
