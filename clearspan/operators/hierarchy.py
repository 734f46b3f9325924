"""Reporting hierarchy level of settlement rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.operators.skew import HOT_ROWS, lookup_join

#: Own top entity, entity with others below it, leaf.
TOP, GROUP, LEAF = 10, 1, 0


def with_aggregation_level(
    rows: DataFrame,
    parent: str,
    entity: str,
    scope: Sequence[str] = (),
    out: str = "aggregation_level",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add 10 for an entity that is its own parent, 1 for a parent of others, else 0.

    ``scope`` limits the search for children to rows of the same values (for
    instance one file).
    """
    parents = (
        rows.filter(F.col(parent) != F.col(entity))
        .select(*scope, F.col(parent).alias("_parent"))
        .distinct()
        .withColumn("_is_parent", F.lit(True))
    )
    on = {**{c: c for c in scope}, entity: "_parent"}
    joined = lookup_join(rows, parents, on, ["_is_parent"], hot_rows)
    level = (
        F.when(F.col(parent) == F.col(entity), TOP)
        .when((F.col(parent) != F.col(entity)) & F.col("_is_parent"), GROUP)
        .otherwise(LEAF)
    )
    return joined.withColumn(out, level).drop("_is_parent")
