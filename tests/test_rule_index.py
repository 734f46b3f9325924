"""Rule books of thousands of rules, rate maps in both routes, and the plans of both."""

import random

import pytest
from pyspark.sql import functions as F

from clearspan.operators import fx, rules
from clearspan.operators.rules import RuleBook, assign_first_rule

BOOK = RuleBook(
    scope={"scope": "region", "code": "ird"},
    kinds={"a": "member", "m": "range", "t": "compare", "s": "space", "amount": "amount"},
    amount_currency="ccy",
)


def book_of(n, scopes, rng):
    """Random rules of every kind of condition, two thousand texts and more."""
    pick = lambda p, make: make() if rng.random() < p else None
    out = []
    for i in range(n):
        low = rng.randint(0, 900)
        out.append(
            (
                f"R{rng.randrange(scopes)}", "75", str(i + 1), "1990-01-01" if rng.random() < 0.9 else None, pick(0.2, lambda: "1995-06-30"),
                pick(0.7, lambda: ("NOT:" if rng.random() < 0.3 else "") + ",".join(f"V{rng.randrange(40)}" for _ in range(4))),
                pick(0.7, lambda: ("NOT:" if rng.random() < 0.2 else "") + f"{low}-{low + rng.randint(0, 60)},{rng.randint(0, 999)}"),  # noqa: B023
                pick(0.5, lambda: rng.choice([">{}", "<={}", "BETWEEN {} AND 50", "={}"]).format(rng.randint(0, 40))),
                pick(0.3, lambda: rng.choice(["Space,1", "NOT:Space", "5"])),
                pick(0.3, lambda: f">{rng.randint(0, 500)}"), rng.choice(["USD", "EUR", None]),
            )
        )
    return out


RULES = "region string, ird string, rule_id string, valid_from string, valid_until string, a string, m string, t string, s string, amount string, ccy string"


def holds(rule, row):
    (region, ird, _, first, last, a, m, t, s, amount, ccy), (_, scope, code, va, vm, vt, vs, usd, eur, day) = rule, row
    if (scope, code) != (region, ird) or first is None or not first <= day <= (last or "9999"):
        return False
    if a is not None and ((va or "BLANK") in a.replace("NOT:", "").split(",")) == a.startswith("NOT:"):
        return False
    if m is not None:
        spans = [(int(x.partition("-")[0]), int(x.partition("-")[2] or x)) for x in m.replace("NOT:", "").split(",")]
        if any(lo <= int(vm) <= hi for lo, hi in spans) == m.startswith("NOT:"):
            return False

    def compares(text, x):
        if x is None:
            return False
        if text.startswith("BETWEEN"):
            lo, hi = text.replace("BETWEEN", "").split("AND")
            return float(lo) <= x <= float(hi)
        op, bound = (text[:2], text[2:]) if text[1] == "=" else (text[0], text[1:])
        return {">": x > float(bound), "<=": x <= float(bound), "=": x == float(bound)}[op]

    if t is not None and not compares(t, vt):
        return False
    if s is not None and (vs in s.replace("NOT:", "").replace("Space", " ").split(",")) == s.startswith("NOT:"):
        return False
    return amount is None or (ccy is not None and compares(amount, usd if ccy == "USD" else eur))


@pytest.mark.parametrize(("n", "scopes", "per_pass"), [(2000, 40, 1024), (2000, 1, 1024), (300, 2, 70)])
def test_thousands_of_rules_equal_brute_force(spark, n, scopes, per_pass):
    rng = random.Random(n + scopes)
    book = book_of(n, scopes, rng)
    rows = [
        (
            k, f"R{rng.randrange(scopes + 1)}", rng.choice(["75", "75", "75", "80"]), rng.choice([None, *[f"V{i}" for i in range(45)]]), str(rng.randint(0, 999)),
            rng.choice([None, *range(60)]), rng.choice([" ", "1", "5"]), rng.choice([None, 0.0, 250.0, 400.0, 600.0]), rng.choice([None, 100.0, 300.0]),
            rng.choice(["1989-12-31", "1992-01-01", "1995-06-30", "1995-07-01"]),
        )
        for k in range(400)
    ]
    frame = spark.createDataFrame(rows, "k int, scope string, code string, a string, m string, t int, s string, amount_usd double, amount_eur double, day string")
    table = spark.createDataFrame(book, RULES)
    got = assign_first_rule(frame, table, BOOK, ["rule_id"], F.col("day").cast("date"), per_pass)
    assert got.columns == [*frame.columns, "rule_id"]
    want = {r[0]: next((x[2] for x in book if holds(x, r)), None) for r in rows}
    assert sum(v is not None for v in want.values()) > 100
    assert {r["k"]: r["rule_id"] for r in got.collect()} == want


def test_rows_are_not_shuffled(spark):
    rng = random.Random(1)
    table = spark.createDataFrame(book_of(2000, 3, rng), RULES)
    rates = spark.createDataFrame([("1995-01-01", "USD", "EUR", 0.5)], "app_processing_date string, currency_from string, currency_to string, exchange_value double")
    rows = spark.range(1000).select(
        F.col("id").alias("k"), F.lit("R1").alias("scope"), F.lit("75").alias("code"), F.lit("V1").alias("a"), F.lit("5").alias("m"), F.lit(3).alias("t"),
        F.lit(" ").alias("s"), F.lit(1.0).alias("amount"), F.lit("1995-01-01").alias("day"), F.lit("USD").alias("ccy_of_row"),
    )
    rows = fx.convert_to_each(rows, rates, F.col("amount"), F.col("ccy_of_row"), F.col("day"), ["USD", "EUR"], "amount")
    done = assign_first_rule(rows, table, BOOK, ["rule_id"], F.col("day").cast("date"))
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_probes_are_looked_up_in_generated_code(spark):
    """No function that is interpreted row by row, no key put together as text."""
    table = spark.createDataFrame(book_of(200, 2, random.Random(3)), RULES)
    rows = spark.createDataFrame(
        [(1, "R0", "75", "V1", "5", 3, " ", 1.0, 2.0, "1995-01-01")],
        "k int, scope string, code string, a string, m string, t int, s string, amount_usd double, amount_eur double, day string",
    )
    done = assign_first_rule(rows, table, BOOK, ["rule_id"], F.col("day").cast("date"))
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "concat(" not in plan


def test_search_of_many_edges_in_several_methods(spark, monkeypatch):
    monkeypatch.setattr(rules, "STEPS_PER_METHOD", 2)
    texts = [("X", "75", str(i + 1), None, None, None, f"{10 * i}-{10 * i + 4}", None, None, None, None) for i in range(50)]
    rows = spark.range(510).select(F.col("id").alias("k"), F.lit("X").alias("scope"), F.lit("75").alias("code"), F.col("id").cast("string").alias("m"))
    done = assign_first_rule(rows, spark.createDataFrame(texts, RULES), BOOK, ["rule_id"])
    got = {r["k"]: r["rule_id"] for r in done.collect()}
    assert got == {k: str(k // 10 + 1) if k % 10 < 5 and k < 500 else None for k in range(510)}


def test_rule_book_without_rules_or_conditions(spark):
    rows = spark.createDataFrame([(1, "X", "75", None), (2, None, "75", "A")], "k int, scope string, code string, a string")
    empty = spark.createDataFrame([], RULES)
    assert [r["rule_id"] for r in assign_first_rule(rows, empty, BOOK, ["rule_id"]).collect()] == [None, None]
    bare = spark.createDataFrame([("X", "75", "7", *[None] * 8), ("X", "75", "8", *[None] * 8), ("BLANK", "75", "9", *[None] * 8)], RULES)
    got = {r["k"]: r["rule_id"] for r in assign_first_rule(rows, bare, BOOK, ["rule_id"]).collect()}
    assert got == {1: "7", 2: "9"}


def test_oversized_index_is_refused(spark, monkeypatch):
    monkeypatch.setattr(rules, "MAX_INDEX_BYTES", 1000)
    table = spark.createDataFrame(book_of(50, 1, random.Random(2)), RULES)
    rows = spark.createDataFrame([(1, "R0", "75")], "k int, scope string, code string")
    with pytest.raises(ValueError, match="rule index"):
        assign_first_rule(rows, table, BOOK, ["rule_id"])


@pytest.mark.parametrize("limit", [fx.MAP_BYTES, 0])
def test_rate_maps_in_both_routes(spark, limit):
    """Rates stored twice, unknown days and currencies, nulls on both sides; broadcast, and joined with hot keys apart."""
    rates = [("d1", "USD", "EUR", 0.5), ("d1", "USD", "EUR", 0.6), ("d1", "USD", "JPY", 9.0), ("d2", "EUR", "USD", 2.0), ("d1", None, "USD", 1.5), ("d2", "GBP", None, 7.0)]
    table = spark.createDataFrame(rates, "app_processing_date string, currency_from string, currency_to string, exchange_value double")
    rows = [(1, "d1", "USD", "EUR"), (2, "d1", "USD", "USD"), (3, "d2", "EUR", "USD"), (4, "d3", "EUR", "USD"), (5, None, "USD", "EUR"), (6, "d1", None, "USD"), (7, "d1", "USD", None), (1, "d1", "USD", "EUR")]
    frame = spark.createDataFrame(rows, "k int, day string, ccy string, target string")
    maps = fx.RateMaps(table, limit=limit)
    assert maps.small == (limit > 0)
    got = maps.onto(frame, "fx", F.col("day"), F.col("ccy")).withColumn("rate", fx.rate_into("fx", F.col("ccy"), F.col("target")))
    assert got.columns == [*frame.columns, "fx", "rate"]
    rate = {(d, a, b): max(x[3] for x in rates if x[:3] == (d, a, b)) for d, a, b, _ in rates if a and b}
    want = sorted((k, 1.0 if a == b else rate.get((d, a, b))) for k, d, a, b in rows)
    found = sorted((r.k, r.rate) for r in got.collect() if r.k != 6)
    assert found == [w for w in want if w[0] != 6]
    assert fx.convert_to_each(frame, table, F.lit(1.0), F.col("ccy"), F.col("day"), [], "x").columns == frame.columns
