"""The month of scheme fees: detail, report, returned costs and back to the detail, as one chain of stored tables.

Every detail row gets the id of its report group once, two 64-bit hashes of all group columns with a mark for each null. The
id goes with it through cube, report and push back, so that the costs of a group reach its rows by
one join on two numbers. Each table is written once, and the counts that the steps must agree on are taken while it is
written, those of the numbered report from one stored column.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clearspan.operators.quality import fill_unknown
from clearspan.operators.skew import HOT_KEYS, HOT_ROWS, global_row_number, lookup_join
from clearspan.plans.schemefee import (
    COSTS,
    CUBE_KEYS,
    ID_ORDER,
    apply_returned_costs,
    detail_of_all,
    legacy_report,
    with_size_tickets,
    with_switch_codes,
)
from clearspan.session import MAX_STEPS, ensure_checkpoint_dir, removed, shuffles_dropped, slice_of, slices, steps_for, written

#: The id of a report group.
GROUP_ID = ["group_id_1", "group_id_2"]
#: Decimal places of the amounts that the report adds up, so that a sum does not depend on its order.
PLACES = 4


class CountMismatch(ValueError):
    """Two steps of a month disagree on their rows; nothing after the failing step was written."""


@dataclass(frozen=True)
class Month:
    """Stored tables of an execution."""

    detail: DataFrame
    report: DataFrame
    legacy: DataFrame
    summary: DataFrame


def group_id(columns: Sequence[Column]) -> list[Column]:
    """128-bit id of a group, as two numbers. Hashes pass over nulls, so these are marked apart."""
    nulls = reduce(lambda a, b: a + b, [F.when(c.isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)])
    return [F.xxhash64(F.lit(seed), nulls, *columns).alias(name) for seed, name in enumerate(GROUP_ID)]


def stored(
    parts: Iterable[DataFrame], folder: str, name: str, counts: Mapping[str, Column], by: Mapping[str, Column] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """``parts`` written one after another below ``folder``, and ``counts`` taken from the rows as they are written.

    The shuffle files of a part go when it is there, so the disk holds those of one part at a time. ``by`` adds columns
    whose values get folders of their own.
    """
    by, total = dict(by or {}), dict.fromkeys(counts, 0)
    for df in parts:
        seen, spark, schema = Observation(f"{name}-{uuid.uuid4().hex}"), df.sparkSession, df.withColumns(by).schema
        with shuffles_dropped(spark):
            df.observe(seen, *[c.alias(k) for k, c in counts.items()]).withColumns(by).write.partitionBy(*by).mode("append").option(
                "compression", "zstd"
            ).parquet(f"{folder}/{name}")
        total = {k: v + (seen.get[k] or 0) for k, v in total.items()}
    return spark.read.schema(schema).parquet(f"{folder}/{name}"), total


def agree(what: str, **counts: int) -> None:
    """Refuse to go on when counts differ."""
    if len(set(counts.values())) > 1:
        raise CountMismatch(f"{what}: " + ", ".join(f"{k} {v}" for k, v in counts.items()))


def month_detail(frames: Sequence[DataFrame], ranges: DataFrame, tickets: DataFrame, rates: DataFrame) -> DataFrame:
    """Detail rows of all brands with switch code, ticket size, report defaults and group id."""
    rows = with_size_tickets(with_switch_codes(detail_of_all(frames), ranges), tickets, rates)
    return fill_unknown(rows).select("*", *group_id([F.col(d) for d in CUBE_KEYS.values()]))


def month_groups(detail: DataFrame) -> DataFrame:
    """A row for each group of the detail; sums are combined before the shuffle."""
    amount = F.col("report_amount").cast(f"decimal(38,{PLACES})")
    return detail.groupBy(*GROUP_ID, *[F.col(d).alias(r) for r, d in CUBE_KEYS.items()]).agg(
        F.sum("transaction_count").cast("bigint").alias("transaction_count"), F.sum(F.round(amount, PLACES)).cast("double").alias("transaction_amount")
    )


def month_report(detail: DataFrame, first_day: str, file_hash: str) -> DataFrame:
    """A numbered row for each group, costs at zero."""
    return numbered_groups(month_groups(detail), first_day, file_hash)


def numbered_groups(groups: DataFrame, first_day: str, file_hash: str, steps: int = 1, folder: str | None = None) -> DataFrame:
    """Report rows of the groups, which are a stored table if they are numbered in ``steps``."""
    order = [F.asc_nulls_first(c) for c in [*ID_ORDER, *[k for k in CUBE_KEYS if k not in ID_ORDER]]]
    return global_row_number(groups, order, "app_id", by=ID_ORDER[0], steps=steps, folder=folder).withColumns(
        {
            "app_type_file": F.lit("report"),
            "app_hash_file": F.lit(file_hash),
            "app_processing_date": F.lit(first_day).cast("date"),
            **{c: F.lit(0.0) for c in COSTS},
        }
    )


def with_group_costs(detail: DataFrame, report: DataFrame, rows: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Costs of the report on every detail row of its group; ``_group`` tells the rows that have one.

    The report knows how many rows each group has, so hot groups need no count. At most ``HOT_KEYS`` groups
    can hold more than that share of the month's ``rows``; they are broadcast, the others joined by id.
    """
    least = max(hot_rows, rows // HOT_KEYS)
    costs = report.select(*GROUP_ID, F.col("app_id").alias("_group"), *[F.col(r).alias(f"_cost_{d}") for r, d in COSTS.items()])
    heavy = report.filter(F.col("transaction_count") > least).select(*GROUP_ID)
    values = ["_group", *[f"_cost_{d}" for d in COSTS.values()]]
    joined = lookup_join(detail, costs, {c: c for c in GROUP_ID}, values, heavy=heavy)
    new = {d: F.coalesce(F.col(f"_cost_{d}"), F.col(d)) for d in COSTS.values()}
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in detail.columns], "_group")


def run_month(
    frames: Sequence[DataFrame],
    ranges: DataFrame,
    tickets: DataFrame,
    rates: DataFrame,
    products: DataFrame,
    funding: DataFrame,
    countries: DataFrame,
    returned: Callable[[DataFrame], DataFrame],
    execution: str,
    month: str,
    first_day: str,
    folder: str | None = None,
    spent: Sequence[str] = (),
    steps: int | None = None,
) -> Month:
    """Run the chain for one execution.

    ``frames`` are the detail rows of every kind of record. ``returned`` gives the external costs for a report, by its ids.
    Tables go below ``folder``, which must not hold this execution yet (the shared checkpoint folder if none is
    given). A large month is worked on in ``steps`` (by its rows, if not given), each over some slices of the group ids, ids or accounts. What a
    later table replaces is deleted, and so are the ``spent`` folders, which only ``frames`` read, once the detail is there.

    Raises :class:`CountMismatch` where the report does not count every detail row once, the older format or the
    returned costs change the number of groups, two groups share an id, or a detail row gets no group back.
    """
    spark = frames[0].sparkSession
    folder = f"{folder or ensure_checkpoint_dir(spark)}/scheme-fees-{execution}-{month}-{uuid.uuid4().hex}"
    every = F.count(F.lit(1))
    by_slice = {"_slice": slice_of(GROUP_ID, MAX_STEPS)}
    detail, n = stored([month_detail(frames, ranges, tickets, rates)], folder, "detail", {"rows": every}, by_slice)
    for path in spent:
        removed(spark, path)
    steps = min(steps or steps_for(n["rows"]), MAX_STEPS)
    mine = [F.col("_slice") % steps == k for k in range(steps)]
    groups = written(*[month_groups(detail.filter(own)) for own in mine], folder=f"{folder}/groups")
    report = numbered_groups(groups, first_day, execution, steps, f"{folder}/numbered")
    removed(spark, f"{folder}/groups")
    # numbering has stored the report, so its counts are read from one column of it
    counted = report.agg(every.alias("groups"), F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("transactions")).first()
    agree("report against detail", detail_rows=n["rows"], transactions=counted["transactions"])
    costs = [apply_returned_costs(*sides) for sides in slices([report, returned(report)], ["app_id"], steps)]
    priced, after = stored(costs, folder, "report-with-costs", {"groups": every})
    removed(spark, f"{folder}/numbered")
    legacy, older = stored([legacy_report(priced, products, funding, countries)], folder, "report-older-format", {"groups": every})
    agree("groups", report=counted["groups"], with_costs=after["groups"], older_format=older["groups"])

    def pushed_back() -> Iterator[DataFrame]:
        for k, own in enumerate(mine):
            some = priced.withColumns(by_slice).filter(own).drop("_slice")
            yield with_group_costs(detail.filter(own).drop("_slice"), some, n["rows"])
            for number in range(k, MAX_STEPS, steps):
                removed(spark, f"{folder}/detail/_slice={number}")

    done, back = stored(pushed_back(), folder, "detail-with-costs", {"rows": every, "updated": F.count("_group")})
    agree("detail after push back", detail_rows=n["rows"], rows=back["rows"], updated=back["updated"])
    summary = spark.createDataFrame(
        [(execution, month, n["rows"], counted["groups"], counted["transactions"], back["updated"])],
        "app_execution_id string, report_month string, number_of_inserted_rows bigint, number_of_groups bigint, "
        "number_of_transactions bigint, number_of_updated_rows bigint",
    )
    return Month(done.drop("_group"), priced, legacy, summary)
