"""URL filters: host and path rules, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: N-grams of so many characters, hashed into so many features.
LENGTHS = (3, 4, 5)
FEATURES = 2**16
#: The model is fitted on so many labelled urls at most, those with the least hashes.
MOST_LABELLED = 20_000
STEPS, RATE, PULL = 300, 8.0, 1e-4
#: Names are dealt into so many parts; the model without a part judges it, and the offset follows these judgements.
PARTS = 4

# The rules, and names of hosts labelled by hand.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# The names are ordinary words by subject, each class with and without hyphens; none is taken from a table of pages.
BLOCKED_NAMES = (
    "casino-bonus", "poker-spins", "bet-now", "slots-jackpot", "lucky-roulette", "sports-betting", "megabet", "onlinecasino",
    "royalpoker", "bonusslots", "betwinner", "jackpot-city", "blackjack-live", "lottery-winner", "freespins", "bingo-cash",
    "pills-discount", "cheap-meds", "viagra-online", "diet-pills", "weightloss-miracle", "pharmacy-noprescription", "buycialis",
    "cheapmeds", "hairloss-cure", "muscle-steroids", "adult-cams", "xxx-tube", "sex-chat", "hotgirls", "nude-pics", "pornvideos",
    "escort-dates", "livesex", "adultdating", "milf-cams", "spam-links", "link-farm", "click-ads", "tracker-ads", "adserver",
    "popup-ads", "banner-exchange", "ad-tracking", "traffic-booster", "buy-backlinks", "seo-rank-fast", "clickfraud",
    "doubleclicks", "adnetwork", "win-prizes", "free-cash", "free-iphone", "gift-card-winner", "claim-reward", "easymoney",
    "getrichquick", "survey-prize", "free-giveaway", "winbig", "payday-loans", "crypto-doubler", "instant-credit", "debt-relief-now",
    "bitcoin-profit", "forex-signals", "cashadvance", "quickloans", "warez-keygen", "crack-serial", "free-torrents",
    "hacked-accounts", "replica-watches", "fake-diplomas", "cheap-handbags", "virus-alert", "password-verify", "account-suspended",
)
ALLOWED_NAMES = (
    "news", "library", "weather", "museum", "recipes", "garden", "university", "history", "science", "travel", "gazette",
    "daily-herald", "evening-post", "radio", "journal", "observer", "magazine", "city-council", "parliament", "county-records",
    "firestation", "policeforce", "townhall", "embassy", "highschool", "kindergarten", "college", "physics-dept", "mathematics",
    "biology", "chemistry", "astronomy", "geology", "linguistics", "philosophy", "encyclopedia", "dictionary", "archives", "gallery",
    "opera", "orchestra", "cinema", "ballet", "photo-club", "painting", "poetry", "bookshop", "publisher", "hospital", "dentist",
    "nursing", "clinic", "veterinary", "bakery", "coffee-house", "restaurant", "cheese-makers", "vineyard", "butcher", "farmers-market",
    "orchard", "football-club", "cycling", "swimming", "chess", "hiking-trails", "sailing", "tennis", "railway", "airport",
    "bus-timetable", "harbour", "hotel", "camping", "maps", "carpenter", "plumbing", "electrician", "architects", "hardware",
    "software", "developers", "open-source", "linux-users", "databases", "robotics", "insurance", "savings-bank", "law-firm",
    "accountants", "furniture", "knitting", "pottery", "bird-watching", "beekeeping", "church", "charity", "volunteers",
    "mountain-rescue", "family-tree",
)
_PREFIXES = ("", "www.", "blog.", "m.")
_SUFFIXES = (".example.com", ".example.net", ".example.org", ".com")
_PATHS = ("/", "/en/12", "/fr/345.html", "/de/6/", "/es/78?page=2")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then up to `?`, `#` or the end."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, parts, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(known, parts, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. Rules are a short list, tried in turn."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, begin = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + begin)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(name, url, label): the small labelled table, hosts of each class under the same prefixes, suffixes and paths."""
    names = spark.createDataFrame([(n, 1) for n in BLOCKED_NAMES] + [(n, 0) for n in ALLOWED_NAMES], "name string, label int")
    for column, values in (("prefix", _PREFIXES), ("suffix", _SUFFIXES), ("path", _PATHS)):
        names = names.withColumn(column, F.explode(F.array(*(F.lit(v) for v in values))))
    return names.select("name", F.concat(F.lit("http://"), "prefix", "name", "suffix", "path").alias("url"), "label")


@dataclass
class Model:
    """A weight for each feature, and an offset; its size is that of the features."""

    weights: np.ndarray
    offset: float

    def probability(self, host: str, path: str) -> float:
        features, values = ngrams(host, path)
        z = self.offset + float(self.weights[features] @ values)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def ngrams(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of host and path, each within its own marks, and values of unit length."""
    counts: dict[int, int] = {}
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in LENGTHS:
            for k in range(len(text) - n + 1):
                key = zlib.crc32(f"{mark}{text[k : k + n]}".encode()) % FEATURES
                counts[key] = counts.get(key, 0) + 1
    values = np.sqrt(np.fromiter(counts.values(), float, len(counts)))
    return np.fromiter(counts.keys(), np.int64, len(counts)), values / max(1e-12, float(np.linalg.norm(values)))


def fit(labelled: DataFrame, most: int = MOST_LABELLED) -> Model:
    """The model of a bounded number of rows (url, label), label 1 for what is to be blocked.

    Rows may have a `name` that several hosts share; without it each host is its own. The offset is moved
    to where both classes together are misjudged least by models that have not seen the name, so that
    `block` from 0.5 on holds for unknown hosts. Null labels don't count. Without any label the model allows all.
    """
    host, path = host_and_path(F.col("url"))
    name = F.coalesce(F.col("name"), host) if "name" in labelled.columns else host
    known = labelled.filter("label IS NOT NULL")
    rows = known.select(host.alias("host"), path.alias("path"), F.col("label").cast("int").alias("label"), name.alias("name"))
    sample = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "label", "name").limit(most).collect()
    if not sample:
        return Model(np.zeros(FEATURES), -20.0)
    examples = [ngrams(row.host, row.path) for row in sample]
    label = np.array([row.label for row in sample], float)
    weights, offset = _trained(examples, label)
    return Model(weights, offset - threshold(*held_out(examples, label, [row.name for row in sample])))


def held_out(examples: list, label: np.ndarray, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each example by a model that has not seen its name, and labels; none if a class has one name only."""
    ranked = {n: k for k, n in enumerate(sorted(set(names), key=lambda n: (zlib.crc32(n.encode()), n)))}
    part = np.array([ranked[n] % PARTS for n in names])
    odds, seen = np.zeros(len(names)), np.zeros(len(names), bool)
    for k in range(PARTS):
        left = np.flatnonzero(part != k)
        if len(set(label[left])) < 2:
            continue
        weights, offset = _trained([examples[i] for i in left], label[left])
        for i in np.flatnonzero(part == k):
            features, values = examples[i]
            odds[i], seen[i] = offset + float(weights[features] @ values), True
    return odds[seen], label[seen]


def threshold(odds: np.ndarray, label: np.ndarray) -> float:
    """Where the shares of misjudged rows of both classes have the least sum, the nearest to 0 of equals."""
    if len(set(label)) < 2:
        return 0.0
    values = np.unique(odds)
    cuts = np.concatenate([[0.0], (values[1:] + values[:-1]) / 2])
    clean, spam = np.sort(odds[label == 0]), np.sort(odds[label == 1])
    missed = np.searchsorted(spam, cuts) / len(spam) + 1 - np.searchsorted(clean, cuts) / len(clean)
    return float(min(zip(missed.round(12), np.abs(cuts), cuts, strict=True))[2])


def _trained(examples: list, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset by steps of gradient descent."""
    weights, offset = np.zeros(FEATURES), 0.0
    owner = np.repeat(np.arange(len(examples)), [len(f) for f, _ in examples])
    feature, value = np.concatenate([f for f, _ in examples]), np.concatenate([v for _, v in examples])
    for _ in range(STEPS):
        z = offset + np.bincount(owner, value * weights[feature], len(examples))
        missed = (label - 1 / (1 + np.exp(-np.clip(z, -500, 500)))) / len(examples)
        weights += RATE * (np.bincount(feature, value * missed[owner], FEATURES) - PULL * weights)
        offset += RATE * missed.sum()
    return weights, offset


def judge(pages: DataFrame, model: Model, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of each row of (page_id, url).

    `score` is the model's probability that the url is to be blocked; the verdict is the rule's, or else
    `block` from 0.5 on. A url that is null or has no `://` has an empty host and path and is scored as
    such. Every row is judged by its own url: repeated rows repeat, and an empty table gives an empty
    table. Other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    read = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = pages.select("page_id").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            scores = [model.probability(h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], ["page_id", "host", "path", "score"])

    scored = read.mapInArrow(run, f"page_id {kind}, host string, path string, score double")
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(says, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
