"""Condition texts and the rule index against brute force."""

from clearspan.operators.rules import RuleBook, assign_first_rule, parse_condition, unreadable_conditions

BOOK = RuleBook(scope={"scope": "region"}, kinds={"a": "member", "m": "range", "t": "compare", "s": "space"})


def test_parse_condition():
    assert parse_condition("member", None) is None
    assert parse_condition("member", " NaN") is None
    assert parse_condition("member", "a, b").values == ["A", "B"]
    assert parse_condition("member", "100.0").values == ["100"]
    assert parse_condition("member", "NOT:A").negated
    assert parse_condition("range", "0-100,150").ranges == [(0, 100), (150, 150)]
    assert parse_condition("range", "0-x").never
    assert parse_condition("compare", "BETWEEN 0 AND 10").bounds == [(">=", 0.0), ("<=", 10.0)]
    assert parse_condition("amount", ">0,<100").bounds == [(">", 0.0), ("<", 100.0)]
    assert parse_condition("space", "Space, 1").values == [" ", "1"]


def brute(row, rules):
    def word(v):
        return "BLANK" if v is None else str(v)

    def holds(rule):
        if word(row["scope"]) != rule["region"]:
            return False
        a, m, t, s = rule["a"], rule["m"], rule["t"], rule["s"]
        if a is not None:
            neg, items = a.startswith("NOT:"), a.replace("NOT:", "").split(",")
            value = word(row["a"]).strip() or "BLANK"
            if (value in items) == neg:
                return False
        if m is not None:
            neg, items = m.startswith("NOT:"), m.replace("NOT:", "").split(",")
            listed = set()
            for i in items:
                lo, _, hi = i.partition("-")
                listed |= {str(x) for x in range(int(lo), int(hi or lo) + 1)}
            if (word(row["m"]) in listed) == neg:
                return False
        if t is not None and (row["t"] is None or not eval(f"{row['t']} {t}")):  # noqa: S307 - literal test data
            return False
        return s is None or word(row["s"]) in [x.replace("Space", " ") for x in s.split(",")]

    hits = [r for r in rules if holds(r)]
    return min(hits, key=lambda r: float(r["rule_id"]))["rule_id"] if hits else None


def test_index_equals_brute_force(spark):
    import itertools

    rules = [
        dict(region="X", rule_id="10", a=None, m=None, t=None, s=None),
        dict(region="X", rule_id="9", a="A,BLANK", m="5-7,20", t=None, s=None),
        dict(region="X", rule_id="2", a="NOT:A", m=None, t=">3", s="Space,1"),
        dict(region="Y", rule_id="1", a=None, m="NOT:5-7", t="<=0", s=None),
        dict(region="Y", rule_id="3", a="B", m="6", t=None, s="1"),
        dict(region="BLANK", rule_id="4", a="B", m=None, t=None, s=None),
    ]
    rows = [
        dict(k=i, scope=c, a=a, m=m, t=t, s=s)
        for i, (c, a, m, t, s) in enumerate(
            itertools.product(["X", "Y", None], ["A", " B ", None, "  "], ["6", "06", "20", None], [0, 4, None], [" ", "1"])
        )
    ]
    frame = spark.createDataFrame(rows, "k int, scope string, a string, m string, t int, s string")
    table = spark.createDataFrame(rules, "region string, rule_id string, a string, m string, t string, s string")
    want = {r["k"]: brute(r, rules) for r in rows}
    for per_pass in (1, 2, 1024):
        got = assign_first_rule(frame, table, BOOK, ["rule_id"], per_pass=per_pass)
        assert {r["k"]: r["rule_id"] for r in got.collect()} == want, per_pass


def test_unreadable_condition_never_holds(spark):
    table = spark.createDataFrame([("X", "1", "5-x"), ("X", "2", None)], "region string, rule_id string, m string")
    book = RuleBook(scope={"scope": "region"}, kinds={"m": "range"})
    assert unreadable_conditions(table, book) == [("1", "m")]
    rows = spark.createDataFrame([(1, "X", "5")], "k int, scope string, m string")
    assert assign_first_rule(rows, table, book, ["rule_id"]).collect()[0]["rule_id"] == "2"
