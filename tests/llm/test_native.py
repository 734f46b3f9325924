"""Operators 4 and 5: measurements, policies, targets, positions."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clearspan.catalogue.compare import compare
from clearspan.llm import curriculum, linedup, quality, vectors
from clearspan.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, name):
    ok, note = compare(spark, FOLDER, registry.QUERIES[name], registry.ORACLE[name])
    assert ok, note


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(w):
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    many = {x for x, n in Counter(windows).items() if n > 1}
    return len({i + k for i, x in enumerate(windows) if x in many for k in range(5)})


def test_ledger_of_odd_rows(docs, rows):
    got = quality.ledger(docs)
    assert got.columns.count("n_words") == 1 and "text" not in got.columns and "source" in got.columns
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_repeat_words, r.n_lines) for r in got.collect())
    want = Counter()
    for doc_id, text, *_ in rows:
        w = words(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        want[(doc_id, len(w), sum(map(len, w)), repeated(w), len(lines))] += 1
    assert found == want


def test_policies_and_ablations(docs, no_docs):
    rows = quality.ledger(docs).cache()
    base = quality.mask(quality.POLICIES["base"])
    assert base == 3
    for r in quality.ablations(rows, "v2").collect():
        bit = next(x.bit for x in quality.RULES if x.name == r.rule)
        bits = [x.fail_bits for x in rows.collect()]
        assert (r.n_docs, r.n_failed, r.n_only) == (len(bits), sum(b >> bit & 1 for b in bits), sum(b == 1 << bit for b in bits))
    assert quality.ablations(quality.ledger(no_docs), "v2").count() == 0
    assert quality.filtered(docs).columns == docs.columns
    assert quality.filtered(docs).count() == rows.filter(quality.passes("v2")).count()


def test_mix_meets_targets(spark, docs, no_docs):
    big = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mix = curriculum.mixed(big).toPandas()
    mix["taken"] = mix["copies"].map(len) * mix["size"]
    by = mix.groupby("skey").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), n=("size", "max"))
    assert abs(by.target.sum() - by["size"].sum()) < 1e-6 * by["size"].sum()
    assert (by.target <= 3 * by["size"] + 1e-6).all()
    assert ((by.taken - by.target).abs() <= by.target * 0.05 + 20).all()
    positions = [c["position"] for cs in mix["copies"] for c in cs]
    assert min(positions) >= 0 and max(positions) <= 1
    again = curriculum.mixed(big.repartition(5)).toPandas()
    key = lambda d: sorted((a, len(c)) for a, c in zip(d.doc_id, d["copies"], strict=True))
    assert key(mix) == key(again)
    order = curriculum.training_order(big, curriculum.mixed(big))
    assert order.columns == big.columns and order.count() == len(positions)


def test_mix_of_odd_rows(docs, no_docs):
    mix = curriculum.mixed(docs).collect()
    assert len(mix) == docs.count()
    assert all(len(r["copies"]) <= 3 for r in mix) and not any(r["copies"] for r in mix if r["size"] == 0)
    assert curriculum.mixed(no_docs).count() == 0
    assert curriculum.training_order(docs, curriculum.mixed(docs)).columns == docs.columns


def test_time_inverts_demand(spark):
    sources = spark.createDataFrame([("a", 90.0), ("b", 10.0)], "skey string, target double")
    knots = spark.createDataFrame([("a", 0.0, 0.0), ("a", 0.5, 2.0), ("a", 1.0, 0.0)], "skey string, t double, weight double")
    rows = curriculum.integrated(sources, knots).select("skey", F.explode(F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 1.0)])).alias("f"), "*")
    got = {(r.skey, r.f): r.at for r in rows.select("skey", "f", curriculum.time_of(F.col("segments"), F.col("f") * F.col("target")).alias("at")).collect()}
    assert got[("a", 0.5)] == pytest.approx(0.5) and got[("a", 1.0)] == pytest.approx(1.0)
    assert got[("a", 0.25)] == pytest.approx((0.25 / 2) ** 0.5) and got[("b", 0.25)] == pytest.approx(0.25)


def test_line_runs_of_odd_rows(docs, rows, no_docs):
    got = linedup.without_repeats(docs)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows) and by[4].text is None and by[5].text == ""
    assert by[9].n_removed == 0 and by[10].n_removed == 1 and by[10].n_lines == 3
    assert by[1].n_removed == 0 and by[2].text == "" and by[3].n_removed == 0 and by[11].n_removed == 0
    assert linedup.without_repeats(no_docs).count() == 0


def test_search_of_odd_vectors(spark):
    data = [(0, [1.0, 2.0]), (50, [1.0, -1.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (None, [1.0, 1.0])]
    data += [(4, [0.5, 0.5]), (5, [0.5, 0.5]), (6, [0.5, 0.5]), (7, [1e30, 1.0]), (8, [1.0]), (100, []), (9, [0.5, 0.5]), (9, [0.5, 0.5])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    v = vectors.integer_vectors(table)
    got = [(r.query_id, r["rank"], r.vec_id) for r in vectors.top_k(v, v.filter("vec_id % 50 = 0"), 4, block=3).orderBy("query_id", "rank").collect()]
    assert [x[2] for x in got if x[0] == 0] == [7, 4, 5, 6]
    assert [x[2] for x in got if x[0] == 50] == [7, 4, 5, 6]
    assert not [x for x in got if x[0] == 100]
    assert vectors.top_k(v.limit(0), v.limit(0)).count() == 0
