"""Range lookups and skew helpers against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from clearspan.operators import ranges
from clearspan.operators.ranges import best_range, covering_best, range_join
from clearspan.operators.skew import chunked_scan, global_row_number, lookup_join


def _data(spark):
    rnd = random.Random(7)
    ranges = []
    for i in range(60):
        lo = rnd.randrange(-50, 5000)
        ranges.append((i, lo, lo + rnd.choice([0, 1, 9, 64, 700, 3000]), rnd.randrange(5)))
    points = [(i, rnd.randrange(-100, 9000)) for i in range(300)]
    return (
        ranges,
        points,
        spark.createDataFrame(ranges, "id int, lo bigint, hi bigint, day int"),
        spark.createDataFrame(points, "k int, p bigint"),
    )


def test_range_join_and_best(spark):
    ranges, points, r, p = _data(spark)
    pairs = {(x["k"], x["id"]) for x in range_join(p, r, F.col("p"), "lo", "hi").collect()}
    assert pairs == {(k, i) for k, v in points for i, lo, hi, _ in ranges if lo <= v <= hi}
    best = best_range(
        p, r, F.col("p"), "lo", "hi", [-F.col("day"), -F.col("hi"), -F.col("lo"), F.col("id")], ["id"], keep_unmatched=True
    )
    want = {}
    for k, v in points:
        hits = [(-d, -hi, -lo, i) for i, lo, hi, d in ranges if lo <= v <= hi]
        want[k] = min(hits)[3] if hits else None
    assert {x["k"]: x["id"] for x in best.collect()} == want


def test_lookup_join_hot_and_cold(spark):
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 else f"k{i % 20}") for i in range(400)]
    big = spark.createDataFrame(rows, "i int, key string")
    small = spark.createDataFrame([("hot", 1), ("k3", 2), (None, 3)], "key string, v int")
    want = {i: {"hot": 1, "k3": 2, None: 3}.get(k) for i, k in rows}
    for hot in (10, 1000):
        got = lookup_join(big, small, {"key": "key"}, ["v"], hot_rows=hot).collect()
        assert len(got) == len(rows)
        assert {r["i"]: r["v"] for r in got} == want


def test_chunked_scan_equals_window(spark):
    rows = [("a", i, i % 4 == 0, i if i % 7 == 3 else None) for i in range(100)] + [("b", 0, False, None)]
    df = spark.createDataFrame(rows, "g string, i int, start boolean, v int").withColumn("chunk", F.floor(F.col("i") / 9))
    out = chunked_scan(df, ["g"], "chunk", ["i"], {"n": F.col("start").cast("int")}, {"last_v": F.col("v")}).collect()
    for r in out:
        upto = [x for x in rows if x[0] == r["g"] and x[1] <= r["i"]]
        assert r["n"] == sum(x[2] for x in upto)
        seen = [x[3] for x in upto if x[3] is not None]
        assert r["last_v"] == (seen[-1] if seen else None)


def test_global_row_number(spark):
    df = spark.createDataFrame([((i * 37) % 101,) for i in range(101)], "x int")
    got = global_row_number(df, [F.col("x")], "n", 5).collect()
    assert {r["x"]: r["n"] for r in got} == {i: i + 5 for i in range(101)}


def _cover(rows, by, x):
    return min((o for b, lo, hi, o in rows if b == by and lo <= x <= hi), default=None)


@pytest.mark.parametrize("small", [ranges.SMALL_RANGES, 0])
def test_covering_best_of_overlapping_ranges(spark, monkeypatch, small):
    """Nested, touching, equal, empty and reversed ranges of several keys; with and without the one-task numbering."""
    monkeypatch.setattr(ranges, "SMALL_RANGES", small)
    rnd = random.Random(4)
    rows = [(f"c{rnd.randrange(3)}", lo := rnd.randrange(400), lo + rnd.choice([-1, 0, 1, 5, 60, 300]), i) for i in range(150)]
    rows += [("c0", 10, 20, 900), ("c0", 21, 30, 901), ("c0", 10, 20, 902), ("only", 5, 5, 903), (None, 1, 9, 904)]
    table = spark.createDataFrame(rows, "by string, lo bigint, hi bigint, o int")
    got = covering_best(table, ["by"], "lo", "hi", [F.col("o")], ["o"]).collect()
    assert len({(r.by, r.seg_low) for r in got}) == len(got)
    seen = {(r.by, x): r.o for r in got for x in range(r.seg_low, r.seg_high + 1)}
    want = {(b, x): c for b in ("c0", "c1", "c2", "only") for x in range(-5, 800) if (c := _cover(rows, b, x)) is not None}
    assert seen == want
    assert covering_best(table.limit(0), ["by"], "lo", "hi", [F.col("o")], ["o"]).count() == 0


def test_ten_thousand_ranges_of_one_customer(spark):
    """Ranges that lie in each other: no piece meets a range, so rows stay near n log n."""
    n = 10_000
    table = spark.range(n).select(F.lit("c").alias("by"), F.col("id").alias("lo"), (3 * n - F.col("id")).alias("hi"), (n - F.col("id")).alias("o"))
    table = ranges.checkpointed(table)
    found = covering_best(table, ["by"], "lo", "hi", [F.col("o")], ["o"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    got = found.collect()
    assert len(got) == 2 * n - 1
    # inside lo..hi of range k the innermost range has the smallest number
    assert all(r.o == n - min(r.seg_low, 3 * n - r.seg_high, n - 1) for r in got)
