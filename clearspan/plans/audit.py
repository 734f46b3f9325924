"""Load audit: rows loaded against rows registered per file date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.operators.skew import latest_by

#: Ledger states that count as read.
READ_STATES = ["PROCESSED", "REVISION"]
DONE = "PROCESSED"


def rows_loaded(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows per processing date and file type over several tables.

    Each table is counted by itself first; only the counts are united.
    """
    counts = [
        t.groupBy("app_processing_date", "app_type_file").agg(F.count(F.lit(1)).alias("_n")) for t in tables
    ]
    united = counts[0]
    for c in counts[1:]:
        united = united.unionByName(c)
    return united.groupBy("app_processing_date", "app_type_file").agg(F.sum("_n").alias("total_row_loaded"))


def ledger_per_type(ledger: DataFrame) -> DataFrame:
    """Distinct files per date and type, and how often each was processed."""
    return (
        ledger.filter(F.col("description_status").isin(*READ_STATES))
        .groupBy("customer", "file_date", "file_type")
        .agg(F.count("file_date").alias("_rows"), F.count_distinct("code").alias("unique_files"))
        .select(
            "customer",
            "file_date",
            "file_type",
            "unique_files",
            F.expr("_rows div unique_files").alias("file_times_processed"),
        )
    )


def latest_per_date(ledger: DataFrame) -> DataFrame:
    """Last processing day and registered records per file date, newest run of each file."""
    done = ledger.filter(F.col("description_status") == DONE).select(
        "code", "file_date", "process_date", "execution_id", "records_number"
    )
    newest = latest_by(
        done,
        ["code"],
        [-F.unix_date("process_date"), -F.col("execution_id"), F.struct("file_date", "records_number")],
    )
    return newest.groupBy("file_date").agg(
        F.max("process_date").alias("last_processed_date"), F.sum("records_number").alias("total_records_files")
    )


def load_audit(tables: Sequence[DataFrame], ledger: DataFrame, processed_on: str | None = None) -> DataFrame:
    """Registered files, registered records and loaded rows side by side."""
    out = (
        ledger_per_type(ledger)
        .join(latest_per_date(ledger), "file_date")
        .join(
            rows_loaded(tables).toDF("file_date", "file_type", "total_row_loaded"), ["file_date", "file_type"]
        )
    )
    return out if processed_on is None else out.filter(F.col("last_processed_date") == F.lit(processed_on).cast("date"))
