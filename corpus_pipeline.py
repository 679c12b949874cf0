"""The corpus pipeline: toxic documents go, copies and near copies go, sources are mixed, the rest is encoded."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from tidemark.llm.common import table, text_or_empty, written


def _key() -> Column:
    """Names a row by its id and its text, either of which may be null."""
    return F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text_or_empty("text")), 256)


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def own_names(stage: Callable) -> Callable:
    """A stage that sees further columns under names of their own, so that they clash with none of its helpers."""

    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        own = [name if name in DOCUMENT else f"_column{at}" for at, name in enumerate(docs.columns)]
        kept = stage(spark, docs.toDF(*own), folder).select(*own)
        return kept.toDF(*docs.columns)

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half, by a model of the labelled ones.

    Null and empty texts are judged as such, repeated rows alike.
    """
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    # under names of their own, so that no column clashes with the score; the text is sent once
    own = {name: "text" if name == "text" else f"_column{at}" for at, name in enumerate(docs.columns)}
    scored = toxicity.score(docs.select(*(F.col(n).alias(o) for n, o in own.items())), model, carry=list(own.values()))
    return scored.filter("score < 0.5").select(*(F.col(o).alias(n) for n, o in own.items()))


@own_names
def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts; a row that is repeated stays once. Null texts are empty ones."""
    kept = exact_dedup.exact_groups(docs, {"key": _key()}).filter("kept").select("key")
    once = docs.withColumn("_key", _key()).dropDuplicates(["_key"])
    return once.join(kept.hint("merge"), F.col("_key") == F.col("key"), "left_semi").drop("_key")


@own_names
def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each component of near copies: of five-word shingles, 80 % alike or more.

    No two rows have the same id and text, as these are copies. Of several rows with the least id, or
    of rows without ids only, one stays.
    """
    kept = near_dedup.near_groups(docs, words=5, percent=80, carry={"key": _key()}, chosen=True).filter("chosen").select("key")
    return docs.join(kept.hint("merge"), _key() == F.col("key"), "left_semi")


@own_names
def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them; the one where it ends is cut there."""
    mixed = mixing.mix(docs, carry={"_key": _key()}).filter("taken > 0")
    amounts = mixed.select("_key", F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    keyed = docs.withColumn("_of", _key()).join(amounts.hint("merge"), F.col("_of") == F.col("_key"))
    taken = mixing.taken_documents(keyed, F.col("_taken"), F.col("_size")).select(*docs.columns)
    return taken.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives its text again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    # texts are compared by digest, so that tasks hold each text once
    given = F.sha2(text_or_empty("text"), 256).alias("digest")
    rows = docs.select(F.struct("doc_id", "lang", "source", given).alias("row"), "text")
    return bpe.round_trip(rows, path, carry=["row"]).select(
        "row.doc_id",
        "row.lang",
        "row.source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("row.digest")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL can't express toxicity, near copies or encoding: the tests compare `run` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
