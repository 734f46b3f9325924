"""Joins between numbers and number ranges.

Plain Spark plans a ``BETWEEN`` join as a nested loop over the whole range table.
Here ranges are filed under power-of-64 buckets of about their own width, so a
lookup is an equality join on the bucket plus a check. To find the *best* of
several overlapping ranges, the ranges are first cut into disjoint segments, each
holding its best range. A transaction then meets at most one segment: there is
nothing to rank afterwards and the transactions are never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.operators.skew import global_row_number, latest_by
from clearspan.session import checkpointed

#: Each bucket level is 2**6 times as wide as the one below.
LEVEL_BITS = 6
#: Range rows up to which one sorted task and a broadcast are allowed.
SMALL_RANGES = 1_000_000


def _level(width: Column) -> Column:
    """Smallest level whose buckets are at least ``width`` wide."""
    bits = F.when(width <= 1, 0).otherwise(F.length(F.bin(width - 1)))
    return F.ceil(bits / LEVEL_BITS).cast("int")


def _bucketed(ranges: DataFrame, low: str, high: str) -> DataFrame:
    """Ranges filed under the (at most two) buckets of their level they touch."""
    return ranges.withColumn("_level", _level(F.col(high) - F.col(low) + 1)).withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.expr(f"shiftright(`{low}`, {LEVEL_BITS} * _level)"),
                F.expr(f"shiftright(`{high}`, {LEVEL_BITS} * _level)"),
            )
        ),
    )


def _levels(ranges: DataFrame, low: str, high: str) -> dict[int, int]:
    """Levels in use and their row counts; a 64-bit key has at most eleven."""
    level = _level(F.col(high) - F.col(low) + 1).alias("l")
    found = ranges.groupBy(level).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["l"]: r["n"] for r in sorted(found)}


def _long_keys(ranges: DataFrame, low: str, high: str) -> DataFrame:
    return (
        ranges.withColumn(low, F.col(low).cast("bigint"))
        .withColumn(high, F.col(high).cast("bigint"))
        .filter(F.col(low) <= F.col(high))
    )


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    point: Column,
    low: str,
    high: str,
    levels: dict[int, int] | None = None,
) -> DataFrame:
    """All pairs of a point and a range that contains it (inner).

    ``levels`` are the levels of the ranges with their row counts, when known.
    """
    ranges = _long_keys(ranges, low, high)
    levels = levels or _levels(ranges, low, high) or {0: 0}
    key = point.cast("bigint")
    probes = points.withColumn("_point", key).withColumn(
        "_probe",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("l"), F.shiftright(F.col("_point"), LEVEL_BITS * n).alias("b"))
                    for n in levels
                ]
            )
        ),
    )
    filed = _bucketed(ranges, low, high)
    if sum(levels.values()) <= SMALL_RANGES:
        filed = F.broadcast(filed)
    return probes.join(
        filed,
        (F.col("_probe.l") == F.col("_level"))
        & (F.col("_probe.b") == F.col("_bucket"))
        & F.col("_point").between(F.col(low), F.col(high)),
    ).drop("_point", "_probe", "_level", "_bucket")


def best_segments(ranges: DataFrame, low: str, high: str, order: Sequence[Column]) -> DataFrame:
    """Disjoint segments ``seg_low..seg_high``, each with its first range by ``order``.

    ``order`` columns compare ascending, nulls first. The other columns of
    ``ranges`` are kept. The range table is written to the checkpoint folder first:
    it is read several times and is small next to the transactions.
    """
    ranges = checkpointed(_long_keys(ranges, low, high))
    return covering_best(ranges, [], low, high, order, ranges.columns)


def covering_best(ranges: DataFrame, by: Sequence[str], low: str, high: str, order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Disjoint segments (``by``, seg_low, seg_high), each with ``keep`` of the first range by ``order`` that covers it.

    ``ranges`` is a stored table with long bounds; ``by`` columns are not null. The ends of all ranges, in order, number the
    pieces between them. A range is a run of pieces and falls into at most two aligned blocks for each power of two; the
    best range of a block is kept, and a piece asks only the blocks it lies in. So no piece meets a range: rows grow
    with the logarithm of the number of ranges, also where thousands of them lie in each other. Segments
    that no range covers are left out.
    """
    ends = ranges.filter(F.col(low) <= F.col(high)).select(*by, F.explode(F.array(F.col(low), F.col(high) + 1)).alias("_end")).distinct()
    ends = checkpointed(ends)
    n = ends.count()
    if n <= SMALL_RANGES:
        # bounded by SMALL_RANGES, so one sorted task is enough
        number = F.row_number().over(Window.orderBy(*by, "_end")) - 1
        numbered = ends.withColumn("_n", number.cast("bigint"))
    else:
        numbered = global_row_number(ends, [F.col(c) for c in [*by, "_end"]], "_n", 0)
    numbered = checkpointed(numbered)
    following = numbered.select(*[F.col(c).alias(f"_f_{c}") for c in by], F.col("_end").alias("_next"), (F.col("_n") - 1).alias("_n"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_f_{c}") for c in by], F.lit(True))
    pieces = numbered.join(following, "_n").filter(same).select(*by, F.col("_end").alias("seg_low"), (F.col("_next") - 1).alias("seg_high"), "_n")

    def at(end: Column, name: str) -> tuple[DataFrame, Column]:
        side = numbered.select(*[F.col(c).alias(f"_{name}_{c}") for c in by], F.col("_end").alias(f"_{name}_end"), F.col("_n").alias(name))
        hit = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{name}_{c}") for c in by], end == F.col(f"_{name}_end"))
        return side, hit

    located = ranges.filter(F.col(low) <= F.col(high))
    for end, name in ((F.col(low), "_i"), (F.col(high) + 1, "_j")):
        side, hit = at(end, name)
        located = located.join(side, hit).drop(*[f"_{name}_{c}" for c in [*by, "end"]])
    top = max(1, n.bit_length())
    blocks = []
    for k in range(top):
        left, right = F.shiftright(F.col("_i") + ((1 << k) - 1), k), F.shiftright(F.col("_j"), k)
        for x, odd in ((left, left), (right - 1, right)):
            taken = (left < right) & (odd % 2 == 1)
            blocks.append(F.when(taken, F.struct(F.lit(k).alias("k"), x.alias("x"))))
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    value = F.struct(*[F.col(c) for c in keep])
    filed = located.select(F.explode(F.filter(F.array(*blocks), lambda b: b.isNotNull())).alias("b"), rank.alias("_rank"), value.alias("_value"))
    best = filed.groupBy("b.k", "b.x").agg(F.min_by("_value", "_rank").alias("_value"), F.min("_rank").alias("_rank"))
    asked = pieces.select(*by, "seg_low", "seg_high", F.explode(F.sequence(F.lit(0), F.lit(top - 1))).alias("k"), "_n")
    asked = asked.withColumn("x", F.expr("shiftright(_n, k)")).drop("_n")
    found = asked.join(best, ["k", "x"]).groupBy(*by, "seg_low", "seg_high").agg(F.min_by("_value", "_rank").alias("_value"))
    kept = [c for c in keep if c not in by]
    return found.select(*by, "seg_low", "seg_high", *[F.col(f"_value.`{c}`").alias(c) for c in kept])


def best_range(
    points: DataFrame,
    ranges: DataFrame,
    point: Column,
    low: str,
    high: str,
    order: Sequence[Column],
    values: Sequence[str],
    keep_unmatched: bool = False,
) -> DataFrame:
    """Add the values of the first range by ``order`` that contains each point.

    ``points`` keeps its rows, order and partitioning: segments are disjoint, so
    each level is a lookup with at most one match. Segments are broadcast when
    their number is within ``SMALL_RANGES``.
    """
    segments = checkpointed(
        best_segments(ranges, low, high, order).select(
            "seg_low", "seg_high", F.struct(F.lit(True).alias("_hit"), *values).alias("_range")
        )
    )
    levels = _levels(segments, "seg_low", "seg_high")
    filed = _bucketed(segments, "seg_low", "seg_high")
    out = points.withColumn("_point", point.cast("bigint"))
    for n, size in levels.items():
        level = filed.filter(F.col("_level") == n).select(
            F.col("_bucket").alias(f"_b{n}"),
            F.col("seg_low").alias(f"_lo{n}"),
            F.col("seg_high").alias(f"_hi{n}"),
            F.col("_range").alias(f"_r{n}"),
        )
        if size <= SMALL_RANGES:
            level = F.broadcast(level)
        out = out.join(
            level,
            (F.shiftright(F.col("_point"), LEVEL_BITS * n) == F.col(f"_b{n}"))
            & F.col("_point").between(F.col(f"_lo{n}"), F.col(f"_hi{n}")),
            "left",
        ).drop(f"_b{n}", f"_lo{n}", f"_hi{n}")
    if not levels:
        none = F.lit(None)
        out = out.select("*", *[none.cast(ranges.schema[v].dataType).alias(v) for v in values], none.alias("_hit"))
    else:
        found = F.coalesce(*[F.col(f"_r{n}") for n in levels])
        out = out.select(
            *points.columns,
            *[found[v].alias(v) for v in values],
            found["_hit"].alias("_hit"),
        )
    if not keep_unmatched:
        out = out.filter(F.col("_hit"))
    return out.select(*points.columns, *values)


def lookup_segments(points: DataFrame, segments: DataFrame, point: Column, on: Mapping[str, str], value: str) -> DataFrame:
    """Add ``value`` of the segment that holds each point, among the segments whose ``on`` columns agree.

    ``segments`` (seg_low, seg_high) are disjoint for equal ``on`` columns, which map a column of
    ``points`` to one of ``segments``. Each level of widths is one equality join, so a point
    meets at most one segment. A level within ``SMALL_RANGES`` is broadcast, so ``points`` are not shuffled.
    """
    filed = _bucketed(segments, "seg_low", "seg_high")
    levels = _levels(segments, "seg_low", "seg_high")
    out = points.withColumn("_point", point.cast("bigint"))
    for n, size in levels.items():
        names = {c: f"_{c}{n}" for c in [*on.values(), "_bucket", "seg_low", "seg_high"]}
        level = filed.filter(F.col("_level") == n).select(
            *[F.col(c).alias(name) for c, name in names.items()], F.col(value).alias(f"_value{n}")
        )
        if size <= SMALL_RANGES:
            level = F.broadcast(level)
        hit = (F.shiftright(F.col("_point"), LEVEL_BITS * n) == F.col(names["_bucket"])) & F.col("_point").between(
            F.col(names["seg_low"]), F.col(names["seg_high"])
        )
        for mine, theirs in on.items():
            hit &= F.col(mine) == F.col(names[theirs])
        out = out.join(level, hit, "left").drop(*names.values())
    found = F.coalesce(*[F.col(f"_value{n}") for n in levels], F.lit(None).cast(segments.schema[value].dataType))
    return out.select(*points.columns, found.alias(value))


def prefix_bounds(low: Column, high: Column, digits: int) -> tuple[Column, Column]:
    """Numeric bounds of account prefixes: nine digits, padded with zeros and nines.

    Beyond 18 digits the last ones are left out (they are padding on both sides),
    so that the bounds stay within 64 bits.
    """
    width = min(digits, 18)
    lo = F.rpad(F.left(F.trim(low), F.lit(9)), width, "0").cast("bigint")
    hi = F.rpad(F.left(F.trim(high), F.lit(9)), width, "9").cast("bigint")
    return lo, hi


def account_point(number: Column, digits: int) -> Column:
    """Account number on the scale of :func:`prefix_bounds`."""
    if digits <= 18:
        return number.cast("bigint")
    return F.floor(number.cast("decimal(38,0)") / F.lit(10 ** (digits - 18)).cast("decimal(38,0)")).cast("bigint")


def dedupe_ranges(ranges: DataFrame, low: str, order: Sequence[Column]) -> DataFrame:
    """One range per low key: the first by ``order``."""
    return latest_by(ranges, [low], order)


def band_join(
    df: DataFrame,
    bands: DataFrame,
    amount: Column,
    low: str,
    high: str,
    on: Sequence[tuple[str, str]],
    values: Sequence[str],
) -> DataFrame:
    """Left join to half-open amount bands ``low <= amount < high`` of the same keys."""
    side = bands.select(
        *[F.col(right).alias(f"_e{i}") for i, (_, right) in enumerate(on)],
        F.col(low).alias("_lo"),
        F.col(high).alias("_hi"),
        *values,
    )
    hit = (amount >= F.col("_lo")) & (amount < F.col("_hi"))
    for i, (left, _) in enumerate(on):
        hit = hit & (F.col(left) == F.col(f"_e{i}"))
    return df.join(side, hit, "left").select(*df.columns, *values)
