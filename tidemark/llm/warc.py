"""WARC archives: written with revisit records, read back by following each file's chain of record boundaries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

# What begins a record, what ends it, and the profile of revisits to equal payloads.
MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Smaller payloads are always stored.
LEAST_BYTES = 1000


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, digest, bytes, refers_to): what to store of each row of (page_id, url, html).

    Of rows with equal payloads of at least `least_bytes` that with the largest page_id is stored, and
    the others refer to it. Payloads are told apart by SHA-1 and length. Only digests are grouped, and
    counted before the shuffle; rows join the groups of two and more, in partitions that Spark splits
    where one payload is frequent. A null html is empty; a null page_id is below all others, and rows
    that repeat a page_id with an equal payload are stored each.
    """
    html = F.coalesce("html", F.lit("")).alias("html")
    rows = pages.select("page_id", "url", html).withColumns(
        {"digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html").cast("bigint")}
    )
    shared = written(
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"))
        .agg(F.max("page_id").alias("_stored"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
        .drop("_rows"),
        "warc-shared",
    )
    joined = rows.join(shared, (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_stored")), F.col("_stored"))
    return joined.select("page_id", "url", "html", "digest", "bytes", refers.alias("refers_to"))


def _record(kind: Column, refers: Column) -> Column:
    """A record without its end; a revisit has an empty block and tells the payload's size in a field of its own."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    stored = kind == "response"
    block = F.when(stored, F.col("html")).otherwise("")
    # a line break within a url would end its field
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        ("WARC-Target-URI", url),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("X-Payload-Length", F.col("bytes").cast("string")),
        ("WARC-Profile", F.when(~stored, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(~stored, F.concat(F.lit("<urn:page:"), refers.cast("string"), F.lit(">")))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in fields]
    return F.concat(F.lit(MAGIC), F.concat_ws("", *lines), F.lit("\r\n"), block)


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Writes a record for each page: files of plain WARC records, as many as the pages have partitions."""
    rows = with_revisits(pages, least_bytes)
    kind = F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise("revisit")
    rows.select(_record(kind, F.col("refers_to")).alias("value")).write.option("lineSep", RECORD_END).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, payload) of each record of the archives, whatever the payloads hold.

    Files are read in parts, each cut at every occurrence of the magic line, be it the start of a
    record or text within a payload. A part's cuts sum up to their places in the file. Each cut whose
    head gives a length is a candidate and names its successor's place. Within each part candidates
    are followed to the first place beyond it; between parts pointers are doubled until they reach
    the files' ends; what can't be reached from the first byte of a file is no record. Most records
    are one cut; those that hold the magic line themselves are put together from theirs.

    `payload` is binary, as long as the header says, or as far as the file goes. A file that does
    not begin with a record has none; after a record whose length is wrong none are found in that file.
    """
    read = spark.read.option("lineSep", MAGIC).text(path)
    head = F.substring_index("value", RECORD_END, 1)
    length = F.regexp_extract(head, r"(?im)^Content-Length:[ \t]*([0-9]{1,15})[ \t]*\r?$", 1)
    has_head = F.contains("value", F.lit(RECORD_END)) & (length != "")
    cuts = written(
        read.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),  # grows in a part's order of reading
            F.col("value").cast("binary").alias("cut"),
            F.when(has_head, F.octet_length(head)).alias("head"),
            F.when(has_head, length.cast("bigint")).alias("length"),
        ),
        "warc-cuts",
        "zstd",
    )
    owners = written(_owners(_placed(cuts)), "warc-owners")
    groups = owners.groupBy("file", "owner").agg(F.count(F.lit(1)).alias("_cuts"))
    # what is not a record of one cut: few rows, whose size Spark knows before it joins them to the texts
    odd = written(
        owners.join(
            groups.filter("_cuts > 1 OR owner IS NULL").select(F.col("file").alias("_file"), F.col("owner").alias("_owner")),
            (F.col("file") == F.col("_file")) & F.col("owner").eqNullSafe(F.col("_owner")),
        ).select(F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("seq").alias("_seq"), "owner"),
        "warc-odd",
    )
    same = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")) & (F.col("seq") == F.col("_seq"))
    single = cuts.join(odd, same, "left_anti")
    pieces = F.array_sort(F.collect_list(F.struct("block", "seq", "cut", "head", "length")))
    several = (
        cuts.join(odd.filter("owner IS NOT NULL"), same)
        .groupBy("file", "owner")
        .agg(pieces.alias("_p"))
        .select(
            "file",
            F.aggregate(
                F.slice("_p", F.lit(2), F.size("_p")),
                F.col("_p")[0]["cut"],
                lambda whole, piece: F.concat(whole, F.lit(MAGIC).cast("binary"), piece["cut"]),
            ).alias("cut"),
            F.col("_p")[0]["head"].alias("head"),
            F.col("_p")[0]["length"].alias("length"),
        )
    )
    return single.select("file", "cut", "head", "length").unionByName(several).select(
        "file",
        F.expr("substring(cut, 1, head)").cast("string").alias("header"),
        F.expr(f"substring(cut, head + {len(RECORD_END) + 1}, cast(least(length, {2**31 - 1}) AS int))").alias("payload"),
    )


def field(header: Column, name: str) -> Column:
    """The value of a header's field, null without it."""
    return F.nullif(F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _placed(cuts: DataFrame) -> DataFrame:
    """(file, block, seq, at, next) of each cut: its place, the magic line's first byte, and its successor's."""
    narrow = cuts.select(
        "file",
        "block",
        "seq",
        # with the magic line after it; a file's last cut has none, and nothing follows it
        (F.octet_length("cut").cast("bigint") + len(MAGIC)).alias("bytes"),
        (F.col("head") + F.col("length") + 2 * len(RECORD_END)).alias("reach"),
    )
    starts = narrow.groupBy("file", "block").agg(F.sum("bytes").alias("_sum")).selectExpr(
        "file AS _file",
        "block AS _block",
        "coalesce(sum(_sum) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        " AS _start",
    )
    inside = "OVER (PARTITION BY file, block ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    at = F.col("_start") + F.col("_inside") - len(MAGIC)
    return written(
        narrow.selectExpr("*", f"coalesce(sum(bytes) {inside}, 0) AS _inside")
        .join(starts, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
        .select("file", "block", "seq", at.alias("at"), (at + len(MAGIC) + F.col("reach")).alias("next")),
        "warc-places",
    )


def _owners(places: DataFrame) -> DataFrame:
    """(file, block, seq, owner): for each cut the place of the last record that begins at or before it."""
    records = _reachable(places.filter("at >= 0 AND next IS NOT NULL")).select(
        F.col("file").alias("_file"), F.col("at").alias("_at")
    )
    marked = written(
        places.join(records, (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at")), "left").select(
            "file", "block", "seq", F.col("_at").alias("record")
        ),
        "warc-marked",
    )
    earlier = marked.groupBy("file", "block").agg(F.max("record").alias("_max")).selectExpr(
        "file AS _file",
        "block AS _block",
        "max(_max) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _last",
    )
    inside = "max(record) OVER (PARTITION BY file, block ORDER BY seq) AS _inside"
    return (
        marked.selectExpr("*", inside)
        .join(earlier, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
        .select("file", "block", "seq", F.coalesce("_inside", "_last").alias("owner"))
    )


def _reachable(candidates: DataFrame) -> DataFrame:
    """(file, at): the candidates of (file, block, at, next) on the chains from the files' first bytes."""
    exits = written(
        candidates.groupBy("file", "block").applyInPandas(_exits, "file string, at bigint, leaves bigint"),
        "warc-exits",
    )
    # between parts only those candidates matter by which a chain enters a part
    entered = exits.select("file", F.col("leaves").alias("at")).union(exits.select("file", F.lit(0).cast("bigint")))
    pointers = written(exits.join(entered.distinct(), ["file", "at"]).withColumnRenamed("leaves", "to"), "warc-pointers")
    reached = pointers.filter("at = 0").select("file", "at")
    # after round k all of the first 2^k entries of a file are reached, and pointers skip 2^k of them
    while not pointers.isEmpty():
        ahead = reached.join(pointers, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = written(reached.union(ahead).distinct(), "warc-reached")
        further = pointers.select("file", F.col("at").alias("to"), F.col("to").alias("_to"))
        pointers = written(
            pointers.join(further, ["file", "to"]).select("file", "at", F.col("_to").alias("to")), "warc-pointers"
        )
    entries = reached.select(F.col("file").alias("_file"), F.col("at").alias("_at"))
    entry = candidates.join(entries, (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at")), "left")
    return (
        entry.select("file", "block", "at", "next", F.col("_at").isNotNull().alias("entry"))
        .groupBy("file", "block")
        .applyInPandas(_walk, "file string, at bigint")
    )


def _exits(part: pd.DataFrame) -> pd.DataFrame:
    """From each candidate of a part, where its chain leaves the candidates of that part."""
    part = part.sort_values("at", ascending=False)
    leaves: dict[int, int] = {}
    for at, following in zip(part["at"].tolist(), part["next"].tolist(), strict=True):
        leaves[at] = leaves.get(following, following)  # a successor stands later, so it is known
    return part[["file", "at"]].assign(leaves=list(leaves.values()))


def _walk(part: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a part on chains from its entries."""
    part = part.sort_values("at")
    expected: set[int] = set()
    taken = []
    for at, following, entry in zip(part["at"].tolist(), part["next"].tolist(), part["entry"].tolist(), strict=True):
        on_chain = entry or at in expected
        if on_chain:
            expected.add(following)
        taken.append(on_chain)
    return part.loc[taken, ["file", "at"]]
