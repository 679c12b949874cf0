"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    exact_dedup,
    fill_in_middle,
    language_id,
    merkle,
    mixing,
    near_dedup,
    preference,
    secret_scan,
    toxicity,
    url_filter,
    vptree,
    warc,
)
from tidemark.llm.common import table, text_or_empty, written
from tidemark.llm.statements import STATEMENTS  # noqa: F401
from tidemark.runtime import scratch_dir


def op1_preference(spark: SparkSession, folder: str) -> DataFrame:
    """Preference pairs of all conversations with the same opening, formatted."""
    formatted = preference.format_pairs(preference.pairs_by_opening(table(spark, folder, "conversations")))

    def spans(name: str):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return formatted.select(
        "chosen_id",
        "rejected_id",
        *(F.col(f"{name}_turns").cast("bigint").alias(f"{name}_turns") for name in ("prompt", "chosen", "rejected")),
        F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen_text", 256).alias("chosen_sha256"),
        F.sha2("rejected_text", 256).alias("rejected_sha256"),
        spans("chosen_loss").alias("chosen_loss"),
        spans("rejected_loss").alias("rejected_loss"),
    )


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    rules = secret_scan.BASE + secret_scan.MORE
    found = secret_scan.scan(table(spark, folder, "documents"), rules).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["number"] < len(secret_scan.BASE))

    def count(number: int):
        return F.size(F.filter("spans", lambda s: s["number"] == number)).cast("bigint")

    counts = [count(number).alias(f"n_{rule.kind}") for number, rule in enumerate(secret_scan.BASE)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.named(base, rules), 256).alias("base_sha256"),
        secret_scan.named(F.col("spans"), rules).alias("spans"),
    )


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every page's url."""
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, folder, "pages"), model)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document."""
    documents = table(spark, folder, "documents")
    scored = toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("segments").alias("n_passages"),
    )


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives, and what reading these gives."""
    path = scratch_dir(spark, "warc-archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    records = warc.read_archives(spark, path)

    def value(name: str):
        return warc.field(F.col("header"), name)

    def page(name: str):
        return F.regexp_extract(value(name), r"<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")

    stored = value("WARC-Type") == "response"
    return records.select(
        page("WARC-Record-ID").alias("page_id"),
        F.when(stored, F.octet_length("payload")).otherwise(value("X-Payload-Length")).cast("bigint").alias("payload_bytes"),
        F.when(stored, F.sha1("payload")).otherwise(F.regexp_extract(value("WARC-Payload-Digest"), "^sha1:(.*)", 1)).alias("payload_digest"),
        value("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, and their text again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, folder, "documents"), path)
    numbered = encoded.select(
        F.struct(
            "doc_id",
            F.size("ids").cast("bigint").alias("n_tokens"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        ).alias("row"),
        "ids",
    )
    decoded = bpe.decode(numbered, path, carry=["row"])
    return decoded.select("row.*", F.sha2("text", 256).alias("decoded_sha256"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts among all documents."""
    digest = F.sha2(text_or_empty("text"), 256)
    return exact_dedup.exact_groups(table(spark, folder, "documents"), {"text_sha256": digest})


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near duplicates among all documents."""
    return near_dedup.near_groups(table(spark, folder, "documents"))


def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of all vectors to every twentieth."""
    vectors = vptree.usable(table(spark, folder, "embeddings"))
    return vptree.search(vptree.index(vectors), vectors.filter("vec_id % 20 = 0"), k=20)


def op10_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents."""
    return mixing.mix(table(spark, folder, "documents"))


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The Merkle manifest of all documents by language, checked against texts that were tampered with."""
    documents = table(spark, folder, "documents")
    values = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    leaves = documents.select(
        F.col("lang").alias("grp"),
        F.col("doc_id").cast("bigint").alias("id"),
        merkle.leaf([*values, "text"]).alias("digest"),
        F.when(tampered, merkle.leaf([*values, lowered])).alias("changed"),
    )
    manifest = merkle.build(written(leaves, "leaves"))
    folded = merkle.fold(F.coalesce("changed", "digest"))
    shown = merkle.proofs(manifest).select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        F.sha2(merkle.joined_siblings(), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    documents = table(spark, folder, "documents")
    predicted = language_id.predict(documents, language_id.fit(documents))
    return predicted.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in a form with its middle last, and its text again."""
    cut = fill_in_middle.transform(table(spark, folder, "documents"))
    facts = F.struct("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"))
    again = fill_in_middle.restore(cut.select(facts.alias("row"), "form", "output"), carry=["row"])
    return again.select("row.*", F.sha2("text", 256).alias("restored_sha256"))


REPORTS = {
    "op1_preference": op1_preference,
    "op2_secrets": op2_secrets,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_warc": op5_warc,
    "op6_bpe": op6_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_nearest": op9_nearest,
    "op10_mix": op10_mix,
    "op11_manifest": op11_manifest,
    "op12_language": op12_language,
    "op13_fill_in_middle": op13_fill_in_middle,
}
