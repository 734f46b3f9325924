"""Helpers that keep hot groups out of single tasks.

Every helper is exact: heavy keys take another route, they are never dropped,
capped or sampled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.session import in_steps, written

#: Rows of one key above which it is worth routing around the shuffle.
HOT_ROWS = 1_000_000
#: Upper bound on how many hot keys are broadcast; the rest use the shuffle.
HOT_KEYS = 10_000


def bounded_rows(df: DataFrame, max_rows: int, what: str) -> list:
    """Bring a metadata table to the driver, refusing anything above its bound."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows")
    return rows


def counted_broadcast(side: DataFrame, table: DataFrame, most: int) -> DataFrame:
    """``side`` marked for broadcast if ``table``, which it is made from row by row, has at most ``most`` rows.

    Spark takes a join of small tables for as large as their product, and would shuffle the facts for it.
    """
    return F.broadcast(side) if table.limit(most + 1).count() <= most else side


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the smallest ``order`` tuple of every key.

    Same answer as ``row_number() = 1`` but as a ``min_by`` aggregate, which is
    combined before the shuffle, so a key holding most rows costs one row per
    task instead of one huge sort. Order columns compare ascending, nulls first;
    negate numbers for descending order.
    """
    keep = [c for c in (values or df.columns) if c not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*keep), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("_best")
    )
    return best.select(*keys, *[F.col(f"_best.`{c}`").alias(c) for c in keep])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, max_keys: int = HOT_KEYS) -> DataFrame:
    """The heaviest keys of ``df`` (at most ``max_keys`` rows)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .orderBy(F.desc("_n"))
        .limit(max_keys)
        .select(*keys)
    )


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    values: Sequence[str],
    hot_rows: int = HOT_ROWS,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Left join ``big`` to a table unique on its keys, null-safe and skew-safe.

    ``on`` maps columns of ``big`` to columns of ``lookup``. Lookup rows of hot
    keys (a bounded number) are broadcast; ``heavy`` gives these keys, named as in ``big``, where they are known. The same rows of ``big`` then get a
    spread-out helper key, so the remaining shuffle join never piles them into
    one task; every other row is joined as usual.
    """
    right_keys = {left: f"_k{i}" for i, left in enumerate(on)}
    slim = lookup.select(
        *[F.col(right).alias(right_keys[left]) for left, right in on.items()],
        F.struct(*values).alias("_v"),
    )

    def matches(frame: DataFrame, other: DataFrame) -> Column:
        return reduce(
            lambda a, b: a & b, [frame[left].eqNullSafe(other[k]) for left, k in right_keys.items()]
        )

    heavy = (hot_keys(big, list(on), hot_rows) if heavy is None else heavy).select(
        *[F.col(left).alias(f"_h{i}") for i, left in enumerate(on)]
    )
    heavy_match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(right_keys.values())]
    )
    # one row per hot key, also where the lookup has none
    heavy_side = heavy.join(slim, heavy_match, "left").select(
        *[F.col(f"_h{i}").alias(f"_b{i}") for i in range(len(on))],
        F.struct(F.col("_v")).alias("_hot"),
    )
    hot_match = reduce(
        lambda a, b: a & b,
        [F.col(left).eqNullSafe(F.col(f"_b{i}")) for i, left in enumerate(on)],
    )
    tagged = big.join(F.broadcast(heavy_side), hot_match, "left").drop(*[f"_b{i}" for i in range(len(on))])
    tagged = tagged.withColumn(
        "_spread", F.when(F.col("_hot").isNotNull(), F.xxhash64(*big.columns)).otherwise(F.lit(0))
    )
    cold = slim.withColumn("_zero", F.lit(0).cast("bigint"))
    joined = tagged.join(
        cold,
        matches(tagged, cold) & (tagged["_spread"] == cold["_zero"]) & tagged["_hot"].isNull(),
        "left",
    )
    picked = F.when(F.col("_hot").isNotNull(), F.col("_hot._v")).otherwise(F.col("_v"))
    return joined.select(*big.columns, picked.alias("_picked")).select(
        *big.columns, *[F.col(f"_picked.`{v}`").alias(v) for v in values]
    )


def chunked_scan(
    df: DataFrame,
    group: Sequence[str],
    chunk: str,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    carries: Mapping[str, Column] | None = None,
    lows: Mapping[str, Column] | None = None,
    steps: int = 1,
) -> DataFrame:
    """Running sums and last-known values along an ordered group of any size.

    ``lows`` add the least value that an expression has in the whole group, known to all its rows.

    ``chunk`` cuts a group into consecutive pieces of bounded length. Inside a
    piece the value is an ordinary window; between pieces only one summary row
    per piece is scanned. A file holding a third of all rows is therefore
    processed by as many tasks as it has pieces. In several ``steps`` a slice of the pieces is scanned at a time and
    stored, with the shuffle files of one slice on disk; ``df`` is read for each of them.
    """
    sums, carries, lows = dict(sums or {}), dict(carries or {}), dict(lows or {})
    piece = [*group, chunk]
    staged = df
    for name, expr in {**sums, **carries, **lows}.items():
        staged = staged.withColumn(f"_in_{name}", expr)

    running = Window.partitionBy(*piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    def scanned(some: DataFrame, known: DataFrame) -> DataFrame:
        local = some.select(
            "*",
            *[F.sum(f"_in_{n}").over(running).alias(f"_lo_{n}") for n in sums],
            *[F.last(f"_in_{n}", ignorenulls=True).over(running).alias(f"_lo_{n}") for n in carries],
        )
        return local.join(known, piece, "inner").select(
            *[local[c] for c in df.columns],
            *[(F.col(f"_lo_{n}") + F.col(f"_off_{n}")).alias(n) for n in sums],
            *[F.coalesce(F.col(f"_lo_{n}"), F.col(f"_off_{n}")).alias(n) for n in carries],
            *[F.col(f"_off_{n}").alias(n) for n in lows],
        )

    position = F.struct(*order)
    summary = staged.groupBy(*piece).agg(
        *[F.sum(f"_in_{n}").alias(f"_s_{n}") for n in sums],
        *[
            F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), position)).alias(f"_s_{n}")
            for n in carries
        ],
        *[F.min(f"_in_{n}").alias(f"_s_{n}") for n in lows],
    )
    whole = Window.partitionBy(*group)
    before = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *piece,
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.last(f"_s_{n}", ignorenulls=True).over(before).alias(f"_off_{n}") for n in carries],
        *[F.min(f"_s_{n}").over(whole).alias(f"_off_{n}") for n in lows],
    )
    return in_steps(scanned, [staged, written(offsets) if steps > 1 else offsets], piece, steps)


def _cuts(df: DataFrame, by: str, steps: int) -> list[Column]:
    """Conditions that cut a stored table along ``by`` into up to ``steps`` runs of about equal size, nulls first.

    A few values are looked at to place the cuts; every row meets one condition, wherever they lie.
    """
    column = F.col(by)
    share = min(1.0, 200 * steps / max(1, df.count()))
    seen = [r[0] for r in df.select(by).filter(column.isNotNull()).sample(share, 7).orderBy(by).collect()]
    marks = list(dict.fromkeys(seen[len(seen) * n // steps] for n in range(1, steps))) if seen else []
    if not marks:
        return [F.lit(True)]
    first = column.isNull() | (column <= F.lit(marks[0]))
    between = [(column > F.lit(a)) & (column <= F.lit(b)) for a, b in zip(marks, marks[1:])]
    return [first, *between, column > F.lit(marks[-1])]


def global_row_number(
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    start: int | Column = 1,
    by: str | None = None,
    steps: int = 1,
    folder: str | None = None,
) -> DataFrame:
    """Consecutive ids along a total order without a single-task window.

    Rows are range-partitioned, sorted and numbered within their partition while they are written, once (so that a
    number means the same thing in both passes, also after an executor loss), and each partition is numbered from the count
    of the partitions before it. The stored rows are read as they are: they are neither shuffled nor sorted again.
    A stored table can be ordered in ``steps`` along ``by``, the first column of ``order`` if that is ascending, nulls
    first: the disk then holds the shuffle files of one step. Rows are written to a new ``folder``, if it is given.
    """
    cuts = [F.lit(True)] if by is None or steps == 1 else _cuts(df, by, steps)
    ordered = [df.filter(cut).repartitionByRange(*order).sortWithinPartitions(*order) for cut in cuts]
    # the partition in the upper bits, the row of the partition in the lower 33
    tagged = written(*[part.withColumns({"_step": F.lit(n), "_place": F.monotonically_increasing_id()}) for n, part in enumerate(ordered)], folder=folder)
    tagged = tagged.withColumns({"_part": F.shiftright("_place", 33), "_rn": F.col("_place").bitwiseAND((1 << 33) - 1)})
    sizes = tagged.groupBy("_step", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count of the job
    before = Window.orderBy("_step", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_step", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    first = start if isinstance(start, Column) else F.lit(start)
    return tagged.join(F.broadcast(offsets), ["_step", "_part"]).select(
        *df.columns, (F.col("_off") + F.col("_rn") + first).cast("bigint").alias(name)
    )
