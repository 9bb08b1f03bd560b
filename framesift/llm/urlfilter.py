"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

The model is fitted on the driver on a small labelled table (its size is checked); scoring is one
vectorised pass over the urls.  Host and path are taken apart by column expressions.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is
judged by the model's intercept alone; the longest fitting rule wins, ties go to a block; repeated
rows are judged alike; columns named host, path, rule, verdict or probability are replaced, all others pass through.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import spare

TRAINING_LIMIT = 20_000  # labelled urls that may be fitted on the driver
BUCKETS = 1 << 15
LENGTHS = (3, 4, 5)
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path prefix, verdict) of the contract; fixed values.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Words of unwanted and of ordinary hosts; general vocabulary, so that the model learns words and not sites.
_UNWANTED = (
    "casino", "poker", "roulette", "slots", "jackpot", "lottery", "betting", "bets", "gambling", "blackjack", "viagra", "cialis", "pills",
    "pharma", "steroids", "adult", "porn", "xxx", "sexcam", "escort", "nude", "hentai", "warez", "keygen", "serialz", "crackz",
    "phishing", "malware", "spyware", "adserver", "popunder", "clickads", "bannerads", "adtracker", "trackers", "linkfarm", "seospam",
    "spam", "payday", "quickloan", "replica", "counterfeit", "getrich", "freecash",
)
_ORDINARY = (
    "news", "library", "weather", "museum", "recipes", "garden", "school", "travel", "history", "science", "books", "music", "city", "health",
    "football", "opensource", "journal", "university", "gallery", "archive", "theatre", "cinema", "hospital", "bakery", "coffee", "kitchen",
    "bicycle", "railway", "airport", "station", "harbour", "island", "mountain", "river", "forest", "ocean", "planet", "physics", "chemistry",
    "biology", "maths", "language", "dictionary", "grammar", "poetry", "novel", "painting", "drawing", "photo", "camera", "video", "radio",
    "podcast", "television", "festival", "concert", "orchestra", "guitar", "piano", "chess", "puzzle", "sports", "tennis", "hockey", "running",
    "swimming", "climbing", "sailing", "camping", "hotel", "restaurant", "market", "grocery", "flowers", "furniture", "clothing", "shoes",
    "jewelry", "hardware", "software", "developer", "programming", "database", "network", "security", "cloud", "mobile", "computer", "electronics",
    "energy", "solar", "water", "climate", "farming", "animals", "birds", "horses", "family", "parents", "children", "wedding", "church",
    "community", "council", "parliament", "government", "election", "justice", "law", "police", "fire", "post", "bank", "insurance", "finance",
    "economy", "trade", "industry", "factory", "engineering", "construction", "architecture", "design", "fashion", "beauty", "fitness", "medicine",
    "dentist", "nursing", "research", "institute", "academy", "college", "student", "teacher", "lesson", "course", "exam", "career", "jobs",
)
_ENDINGS = ("", "-online", "world", "24", "-club", "hub", "-web", "zone")
_PATHS = ("/", "/en/7817", "/de/120.html", "/fr/33?page=2", "/es/9/", "/article/2020/05", "/about#top", "/index.html", "/search?q=a", "/category/item-12")


def seed_table(spark: SparkSession) -> DataFrame:
    """The small labelled table ``(url, label)``; label 1 is to be blocked.

    Both labels have the same fronts, endings, domains and paths, so that only the words tell them apart.
    """
    rows = []
    for label, words in ((1, _UNWANTED), (0, _ORDINARY)):
        for i, word in enumerate(words):
            for j, ending in enumerate(_ENDINGS):
                front = ("", "www.", "m.", "blog.")[(i + j) % 4]
                domain = ("com", "net", "org", "info", "co.uk", "de")[(i + 3 * j) % 6]
                rows.append((f"https://{front}{word}{ending}.{domain}{_PATHS[(i + 7 * j) % len(_PATHS)]}", label))
    return spark.createDataFrame(rows, "url string, label int")


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, F.greatest(at, F.lit(0)) + 3)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, SMALL)
    return F.when(at > 0, host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, F.greatest(at, F.lit(0)) + 3)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``(size, verdict, rule)`` of the longest fitting rule, else null."""
    found = []
    for name, prefix, verdict in rules:
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        text = name + prefix
        found.append(F.when(fits, F.struct(F.lit(len(text)).alias("size"), F.lit(verdict).alias("verdict"), F.lit(text).alias("rule"))))
    return F.array_max(F.array_compact(F.array(*found)))


def features(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct n-grams; host and path count apart."""
    found = set()
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        raw = text.encode()
        for n in LENGTHS:
            for i in range(len(raw) - n + 1):
                found.add(zlib.crc32(mark.encode() + raw[i : i + n]) % BUCKETS)
    return np.fromiter(sorted(found), np.int64, len(found))


def fit(labelled: DataFrame, ridge: float = 0.02, rounds: int = 300) -> np.ndarray:
    """Weights, the intercept last; full-batch gradient steps on the bounded table.

    The intercept is held to the log odds of the labels: a url of which no n-gram is known is judged by
    their share, and nothing but n-grams can move it.
    """
    rows = (
        labelled.where(F.col("label").isNotNull())
        .select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("double").alias("label"))
        .limit(TRAINING_LIMIT + 1)
        .collect()
    )
    if len(rows) > TRAINING_LIMIT:
        raise ValueError(f"the labelled table holds more than {TRAINING_LIMIT} rows")
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    parts = [features(r["host"], r["path"]) for r in rows]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    column = np.concatenate(parts)
    scale = 1.0 / np.sqrt(np.maximum(1, [len(p) for p in parts]))[row]
    y = np.array([r["label"] for r in rows])
    weights[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for _ in range(rounds):
        margin = np.bincount(row, weights[column] * scale, minlength=len(y)) + weights[-1]
        error = 1 / (1 + np.exp(-margin)) - y
        step = np.bincount(column, error[row] * scale, minlength=BUCKETS) / len(y)
        weights[:-1] -= 20.0 * (step + ridge * weights[:-1] / len(y))
    return weights


def block_probability(spark: SparkSession, weights: np.ndarray, host: Column, path: Column) -> Column:
    sent = spark.sparkContext.broadcast(weights.astype(np.float64))  # BUCKETS + 1 numbers

    def run(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        w, out = sent.value, []
        for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True):
            f = features(h or "", p or "")
            margin = w[-1] + w[f].sum() / np.sqrt(max(1, len(f))) if h or p else w[-1]
            out.append(1 / (1 + np.exp(-margin)))
        return pa.array(out, pa.float64())

    return F.arrow_udf(run, "double")(host, path)


def judge(pages: DataFrame, labelled: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, probability and verdict."""
    weights = fit(labelled)
    found = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    own = spare(pages, "rule_of_")
    found = found.withColumn(own, rule_of(F.col("host"), F.col("path"), rules))
    found = found.withColumn("probability", block_probability(pages.sparkSession, weights, F.col("host"), F.col("path")))
    verdict = F.coalesce(F.col(own)["verdict"], F.when(F.col("probability") >= 0.5, "block").otherwise("allow"))
    return found.withColumns({"rule": F.col(own)["rule"], "verdict": verdict}).drop(own)
