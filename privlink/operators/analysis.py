"""Exposure analysis over a clear, hashed or encrypted linked table.

One parameterised operator serves every copy: only the column names differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

#: Bytes that tell long texts apart: as many as the IV that makes a token its row's own.
DIGEST_BYTES = 16


def told_apart(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with text columns as bytes that are equal where the texts are.

    For counts of distinct values. Texts of less than ``DIGEST_BYTES`` are their own bytes, longer ones the
    front of their SHA-256, so none meets another. A token of about a hundred characters that no
    codec shortens is then moved and compared as 16 bytes. Columns of other types and NULLs stay as they are.
    """
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    digest = {c: F.substring(F.unhex(F.sha2(F.col(c).cast("binary"), 256)), 1, DIGEST_BYTES) for c in texts}
    return df.withColumns({c: F.when(F.octet_length(c) < DIGEST_BYTES, F.col(c).cast("binary")).otherwise(digest[c]) for c in texts})


def exposure_counts(df: DataFrame, uid: str = "SynSocial_UID", record: str = "Synthea_UID", code: str = "code") -> DataFrame:
    """(code, uid, record, n): linked rows per code, user and record, NULLs as
    groups of their own.

    The one pass over a copy from which both analyses follow (``report_of_counts``,
    ``stats_of_counts``). It aggregates map-side before its shuffle; of a clear or hashed
    copy little is left. Of a copy with a token per row nothing is merged, but only
    the three columns that the analyses read are moved.
    """
    return df.groupBy(code, uid, record).agg(F.count(F.lit(1)).alias("n"))


def report_of_counts(counts: DataFrame, uid: str = "SynSocial_UID", code: str = "code") -> DataFrame:
    """``exposure_report`` of ``exposure_counts``."""
    per_user = counts.filter(F.col(code).isNotNull()).groupBy(code, uid).agg(F.sum("n").alias("n"))
    return _per_code(per_user, code)


def stats_of_counts(counts: DataFrame, uid: str = "SynSocial_UID", record: str = "Synthea_UID", code: str = "code") -> DataFrame:
    """``exposure_stats`` of ``exposure_counts``."""
    return told_apart(counts, uid, record).agg(
        F.count_distinct(uid).alias("Social-Media-Users"),
        F.count_distinct(record).alias("Medical-Records"),
        F.count_distinct(code).alias("Medical-Codes"),
    )


def exposure_report(df: DataFrame, uid: str = "SynSocial_UID", code: str = "code") -> DataFrame:
    """Per condition code: users, messages, and messages per user.

    Columns: User_Count float, Medical_Codes, Message_Count float,
    Avg_Msg_per_User double (HALF_UP to 2 places). Only matched rows count.
    Users are the groups of ``(uid, code)``, so a NULL user id forms one
    group of its own, and Message_Count counts linked rows (a message inside
    two spells of one code counts twice).

    Two aggregations, both with map-side partial aggregation: by
    ``(code, uid)`` (spreads a hot code over its users), then by ``code``
    over the much smaller per-user counts. Messages are the sum of the
    per-user counts, so no second pass or join is needed.
    """
    per_user = (
        told_apart(df.filter(F.col(code).isNotNull()), uid)
        .groupBy(code, uid)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _per_code(per_user, code)


def _per_code(per_user: DataFrame, code: str) -> DataFrame:
    """The report's columns of (code, user, n) rows."""
    per_code = per_user.groupBy(code).agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("n").alias("msgs"),
    )
    # the counts are float columns (the report's layout); the average comes
    # from the exact 64-bit counts, which float32 stops holding above 2^24
    return per_code.select(
        F.col("users").cast("float").alias("User_Count"),
        F.col(code).alias("Medical_Codes"),
        F.col("msgs").cast("float").alias("Message_Count"),
        F.round(F.col("msgs") / F.col("users"), 2).alias("Avg_Msg_per_User"),
    )


def exposure_stats(
    df: DataFrame,
    uid: str = "SynSocial_UID",
    record: str = "Synthea_UID",
    code: str = "code",
) -> DataFrame:
    """One row: distinct users, distinct medical records, distinct codes
    (NULLs not counted). One job instead of three collected ones.

    Counts are bigint: on an encrypted copy every token is distinct, so the
    user count equals the row count and would overflow a 32-bit int at scale.
    """
    return stats_of_counts(df, uid, record, code)


def user_code_counts(df: DataFrame, uid: str = "SynSocial_UID", code: str = "code") -> DataFrame:
    """Matched rows per (user, code); NULL user forms a group."""
    return (
        df.filter(F.col(code).isNotNull())
        .groupBy(uid, code)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def distinct_bitmaps(df: DataFrame, columns: tuple[str, ...] | list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, column, bucket, bitmap): the distinct whole numbers of each column as bits.

    For copies whose identifiers are numbers, as in the hashed copy (32-bit hashes
    kept as text). A bucket has 32,768 neighbouring numbers in 4 KB, so a
    32-bit column has 131,072 buckets at most, however many rows there are. Bitmaps of
    parts of a table (``by``: days, batches) merge to those of the whole, without the rows
    (``merge_bitmaps``). NULLs and texts that are no whole number have no bit.

    Single numbers are moved, never bitmaps, which are mostly zeros where a part has
    few numbers of a bucket. A bucket's parts lie next to each other, in order, so that
    merging them neither moves nor sorts the bitmaps.
    """
    numbers = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).try_cast("bigint").alias("number")) for c in columns])
    bits = df.select(*by, F.inline(numbers)).where(F.col("number").isNotNull()).distinct()
    bits = bits.withColumn("bucket", F.bitmap_bucket_number("number")).repartition("column", "bucket")
    bitmaps = bits.groupBy("column", "bucket", *by).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    return bitmaps.select(*by, "column", "bucket", "bitmap")


def merge_bitmaps(bitmaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``distinct_bitmaps`` of parts put together (kept apart by ``by``)."""
    return bitmaps.groupBy(*by, "column", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def stats_of_bitmaps(bitmaps: DataFrame, uid: str, record: str, code: str = "code") -> DataFrame:
    """``exposure_stats`` from merged bitmaps of the three columns."""
    bits = F.bitmap_count("bitmap")
    return bitmaps.agg(
        *[F.coalesce(F.sum(F.when(F.col("column") == c, bits)), F.lit(0)).cast("bigint").alias(name) for c, name in ((uid, "Social-Media-Users"), (record, "Medical-Records"), (code, "Medical-Codes"))]
    )
