"""WARC records and a Merkle audit of replicas.

Records are laid out in files; every record has a digest.  Digests of records in
an offset range give the digest of the range, ranges those of larger ranges, up
to one root per file.  Two replicas are compared root by root, and only the
branches that differ are followed down to the records that are damaged.

Defined results: null fields are empty in the record; identical pages are stored
once, with a count; an empty table has no files and no findings; a file missing
in one replica has all its records reported; extra columns do not enter the
records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from recueil.llm.common import stored

#: Bytes of records that one file holds, about.
FILE_BYTES = 64 << 20

#: Bits of the offset that one range of each level covers; a range of the first
#: level holds as many records as start in 64 KiB, one above it 32 ranges.
RANGE_BITS = (16, 21, 26, 31, 63)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def warc_record(key: Column, url: Column, html: Column) -> Column:
    """One WARC/1.1 resource record as text; the length counts UTF-8 bytes."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\n"),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))),
        _line("WARC-Target-URI", F.coalesce(url, F.lit(""))),
        F.lit("Content-Type: text/html\r\n"),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def record_table(pages: DataFrame, key: str = "page_id", **contents: Column) -> DataFrame:
    """``page_id, length, copies`` and one digest per replica; every different
    record once.

    ``contents`` names a digest column per replica and gives the record as that
    replica has it, null where it lost the record.  The first is the original,
    whose lengths count.  Only digests leave the task that reads a page.
    """
    first = next(iter(contents))
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), *[c.alias(name) for name, c in contents.items()]).select(
        "page_id", F.octet_length(first).cast("bigint").alias("length"), *[F.sha2(name, 256).alias(name) for name in contents]
    )
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


def laid_out(records: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Adds ``file`` and ``offset``.

    Files are filled by a hash of the record, so each has about ``file_bytes``;
    within a file the records follow each other by key and ``digest``.
    """
    total = records.agg(F.sum("length").alias("n")).first()["n"] or 0
    files = max(1, -(-total // file_bytes))
    named = records.withColumn("file", F.pmod(F.xxhash64("page_id", "digest"), F.lit(files)).cast("int"))
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return named.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint"))


def merkle_levels(leaves: DataFrame, bits: Sequence[int] = RANGE_BITS) -> list[DataFrame]:
    """Tables ``file, node, digest`` from the first ranges up to the roots.

    ``leaves`` has ``file, offset, digest``.
    """
    levels, below, used = [], leaves.select("file", F.col("offset").alias("node"), "digest"), 0
    for width in bits:
        parts = F.sort_array(F.collect_list(F.struct("node", "digest")))
        text = F.concat_ws("\n", F.transform(parts, lambda p: F.concat_ws(" ", p["node"].cast("string"), p["digest"])))
        grouped = below.groupBy("file", F.shiftright("node", width - used).alias("node")).agg(F.sha2(text, 256).alias("digest"))
        below, used = stored(grouped, "merkle"), width
        levels.append(below)
    return levels


def audit(original: DataFrame, replica: DataFrame, bits: Sequence[int] = RANGE_BITS) -> DataFrame:
    """``file, offset, original_digest, replica_digest`` of damaged records.

    Both tables have ``file, offset, digest``; a digest is null where a record
    is missing.  A level is read only where the one above differs.
    """
    a, b = merkle_levels(original, bits), merkle_levels(replica, bits)

    def differing(left: DataFrame, right: DataFrame, suspect: DataFrame | None, shift: int) -> DataFrame:
        if suspect is not None:
            parent = ["file", "parent"]
            up = suspect.select("file", F.col("node").alias("parent"))
            left, right = (x.withColumn("parent", F.shiftright("node", shift)).join(up, parent, "left_semi") for x in (left, right))
        both = left.select("file", "node", F.col("digest").alias("original_digest")).join(
            right.select("file", "node", F.col("digest").alias("replica_digest")), ["file", "node"], "full"
        )
        return both.filter(~F.col("original_digest").eqNullSafe(F.col("replica_digest")))

    suspect = None
    for level in range(len(bits) - 1, -1, -1):
        shift = bits[level + 1] - bits[level] if level + 1 < len(bits) else 0
        suspect = stored(differing(a[level], b[level], suspect, shift), "merkle_differs")
    leaves = [x.select("file", F.col("offset").alias("node"), "digest") for x in (original, replica)]
    return differing(*leaves, suspect, bits[0]).withColumnRenamed("node", "offset")
