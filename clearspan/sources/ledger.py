"""File catalogue: classification, fingerprints, reprocess detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.operators.skew import HOT_ROWS, bounded_rows, global_row_number, lookup_join

# --- fixed values -------------------------------------------------------------
#: File type of a pattern -> brand and class of the file.
FILE_CLASSES = {
    "MC Incoming": ("MC", "IN"),
    "MC Outgoing": ("MC", "OUT"),
    "IAR (T067)": ("MC", "MC/OTHER"),
    "VI Incoming": ("VI", "IN"),
    "VI Outgoing": ("VI", "OUT"),
    "ARDEF (EP302)": ("VI", "VI/OTHER"),
}
AMBIGUOUS, UNMATCHED = "CHECK", "OTHER"
EVERY_CUSTOMER = "ALL"
REPEATED, FRESH = "REVISION", "PROCESSED"
# -------------------------------------------------------------------------------


def customer_patterns(patterns: DataFrame, customer: str) -> list[tuple[str, str]]:
    """File type and pattern of the rows for a customer or for all of them."""
    rows = bounded_rows(
        patterns.filter(F.col("customer_code").isin(customer, EVERY_CUSTOMER)), 10_000, "file patterns"
    )
    return [(r["file_type"], r["file_format"]) for r in rows]


def classify(files: DataFrame, name: Column, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``brand`` and ``filetype`` of every file name.

    The patterns of a class become one alternation, so classification is a
    projection: no join of every name with every pattern.
    """
    tests: list[tuple[str, str, Column]] = []
    for kind, (brand, label) in FILE_CLASSES.items():
        own = [p for k, p in patterns if k == kind]
        if own:
            tests.append((brand, label, F.coalesce(name.rlike("|".join(f"(?:{p})" for p in own)), F.lit(False))))
    if not tests:
        return files.withColumns({"brand": F.lit(""), "filetype": F.lit(UNMATCHED)})
    hits = sum((t.cast("int") for _, _, t in tests), F.lit(0))
    brand_of, label_of = F.lit(""), F.lit(UNMATCHED)
    for brand, label, test in reversed(tests):
        brand_of = F.when(test, brand).otherwise(brand_of)
        label_of = F.when(test, label).otherwise(label_of)
    return files.withColumns(
        {
            "brand": F.when(hits > 1, "").otherwise(brand_of),
            "filetype": F.when(hits > 1, AMBIGUOUS).otherwise(label_of),
        }
    )


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file under a path."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("app_hash_file"))


def mark_repeats(ledger: DataFrame, identity: Sequence[str], out: str = "status", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``REVISION`` to ledger rows whose content was registered more than once."""
    seen = ledger.groupBy(*identity).agg((F.count(F.lit(1)) > 1).alias("_again"))
    joined = lookup_join(ledger, seen, {c: c for c in identity}, ["_again"], hot_rows)
    return joined.withColumn(out, F.when(F.col("_again"), REPEATED).otherwise(FRESH)).drop("_again")


def reprocess_queue(
    ledger: DataFrame, customer: str, brand: str, first_day: str, last_day: str
) -> DataFrame:
    """Numbered list of processed files of a period, in order of type and date."""
    chosen = ledger.filter(
        (F.col("description_status") == FRESH)
        & (F.col("customer") == customer)
        & (F.col("brand") == brand)
        & F.col("file_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
        & F.col("file_type").isin("IN", "OUT")
    )
    queue = chosen.select(
        F.col("code").alias("hash_file"),
        F.col("file_type").alias("type_file"),
        "file_date",
        F.date_format("file_date", "yyyyMMdd").alias("header_date"),
    )
    order = [F.col("type_file"), F.col("file_date"), F.col("hash_file")]
    return global_row_number(queue, order, "number_file").drop("file_date")
