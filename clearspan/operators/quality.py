"""Data quality: type checks, quarantine, defaults for unknown values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions.dates import is_julian_yddd

#: Format letters of the check configuration and their Spark patterns.
FORMAT_LETTERS = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%j": "DDD", "%H": "HH", "%M": "mm", "%S": "ss"}


def spark_pattern(fmt: str) -> str:
    """Spark date pattern of a percent-letter format."""
    for letter, pattern in FORMAT_LETTERS.items():
        fmt = fmt.replace(letter, pattern)
    return fmt


def readable(c: Column, kind: str, fmt: str = "", today: Column | None = None) -> Column:
    """Whether a text is a value of the wanted kind."""
    kind = kind.lower()
    if kind == "date":
        pattern = spark_pattern(fmt)
        sized = F.length(c) == len(pattern)
        return sized & F.try_to_timestamp(c, F.lit(pattern)).isNotNull()
    if kind == "date_julian":
        return is_julian_yddd(c, F.current_date() if today is None else today)
    if kind == "int":
        return F.trim(c).rlike(r"^[+-]?[0-9]+$")
    if kind == "float":
        return F.trim(c).rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$")
    raise ValueError(f"unknown kind {kind}")


def with_errors(
    df: DataFrame, checks: Sequence[Mapping[str, str]], out: str = "errors", today: Column | None = None
) -> DataFrame:
    """Add the list of failed checks of every row.

    Each check names a column, a kind and a format. Null and empty text pass; a
    column that is not there is skipped; every column is checked by itself.
    """
    tests = []
    for check in checks:
        name, kind = check["name"], check["kind"]
        if name not in df.columns:
            continue
        c = F.col(f"`{name}`").cast("string")
        given = c.isNotNull() & (c != "")
        bad = given & ~F.coalesce(readable(c, kind, check.get("format", ""), today), F.lit(False))
        tests.append(F.when(bad, F.lit(f"cannot convert {name} to {kind.lower()}")))
    found = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    return df.withColumn(out, found)


def quarantine(checked: DataFrame, out: str = "errors") -> DataFrame:
    """One row per failed check, with its message."""
    kept = [c for c in checked.columns if c != out]
    return checked.filter(F.size(out) > 0).select(*kept, F.explode(out).alias("message_error"))


def clean(checked: DataFrame, out: str = "errors") -> DataFrame:
    """Rows without a failed check."""
    return checked.filter(F.size(out) == 0).drop(out)


def error_profile(checked: DataFrame, out: str = "errors") -> DataFrame:
    """Number of rows per message."""
    return quarantine(checked, out).groupBy("message_error").agg(F.count(F.lit(1)).alias("rows_failed"))


# --- fixed values: what unknown report fields are set to ----------------------
UNKNOWN_TEXT = "UNK"
UNKNOWN_ACCOUNT = "9999999999999999"
MANDATORY_DETAIL = [
    "report_amount",
    "account_range_country",
    "account_funding_source",
    "account_number",
    "jurisdiction",
    "product_id",
    "range_program_id",
]
# -------------------------------------------------------------------------------


def missing_any(columns: Sequence[str]) -> Column:
    """True where one of the columns is null."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def reject_incomplete(detail: DataFrame, columns: Sequence[str] = MANDATORY_DETAIL) -> DataFrame:
    """Rows with every mandatory field."""
    return detail.filter(~missing_any(columns))


def fill_unknown(detail: DataFrame) -> DataFrame:
    """Report defaults for missing fields.

    Jurisdiction and product are only defaulted where the report amount is missing
    too; the amount itself becomes zero at the end.
    """
    no_amount = F.col("report_amount").isNull()
    no_product = F.col("product_id").isNull() & no_amount
    return detail.withColumns(
        {
            "account_range_country": F.coalesce("account_range_country", F.lit(UNKNOWN_TEXT)),
            "account_funding_source": F.coalesce("account_funding_source", F.lit(UNKNOWN_TEXT)),
            "account_number": F.coalesce("account_number", F.lit(UNKNOWN_ACCOUNT)),
            "jurisdiction": F.when(F.col("jurisdiction").isNull() & no_amount, UNKNOWN_TEXT).otherwise(
                F.col("jurisdiction")
            ),
            "product_id": F.when(no_product, UNKNOWN_TEXT).otherwise(F.col("product_id")),
            "range_program_id": F.when(no_product, UNKNOWN_TEXT).otherwise(
                F.coalesce("range_program_id", F.lit(UNKNOWN_TEXT))
            ),
            "report_amount": F.coalesce("report_amount", F.lit(0.0)),
        }
    )
