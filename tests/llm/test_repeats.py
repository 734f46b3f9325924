"""Rows that repeat, and tables without a word: defined results, bounded groups."""

from collections import Counter

from pyspark.sql import functions as F

from clearspan.llm import curriculum, extraction, packing, toxicity


def test_a_mix_without_words_takes_nothing(spark):
    rows = [(1, "", "a"), (2, None, "b"), (3, " \t\n", None)]
    mix = curriculum.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(mix) == 3 and all(r["size"] == 0 and not r["copies"] for r in mix)


def test_targets_by_plain_resharing(spark):
    """Targets of sources in any number, some of them full, against resharing step by step."""
    for sizes in ([5, 5, 5], [1, 1, 1000], [1, 2, 3, 4, 1000], [7], [0, 10], [1, 1, 1, 1, 1, 1, 50000, 3], [0, 0]):
        rows = [(k, " ".join("w" * n), f"s{k:02d}") for k, n in enumerate(sizes)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
        found = {r.skey: r.target for r in curriculum.mixed(frame).select("skey", "target").distinct().collect()}
        weights, caps = [1 + k % 3 for k in range(len(sizes))], [3 * n for n in sizes]
        target, full = [0.0] * len(sizes), set()
        while True:
            rest, open_ = sum(sizes) - sum(caps[k] for k in full), [k for k in range(len(sizes)) if k not in full]
            share = {k: rest * weights[k] / sum(weights[j] for j in open_) for k in open_}
            over = {k for k in open_ if share[k] > caps[k]}
            target = [caps[k] if k in full else share[k] for k in range(len(sizes))]
            if not over:
                break
            full |= over
        got = sorted(found.values())
        assert len(got) == len(sizes) and all(abs(a - b) < 1e-6 * max(1, b) for a, b in zip(got, sorted(target), strict=True)), sizes


def test_equal_rows_fill_many_groups(spark):
    n = 4000
    rows = spark.range(n).select(
        F.lit(1).cast("bigint").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"), F.lit(600).cast("bigint").alias("length"),
        F.lit(7).cast("bigint").alias("ids_crc32"), F.lit(99).cast("bigint").alias("salt"),
    )
    got = packing.packed(rows.repartition(4), group=250).collect()
    per_group = Counter(r.sequence_id >> 32 for r in got)
    assert len(got) == n and len(per_group) == 16 and max(per_group.values()) < 2 * 250
    assert all(c <= 3 for c in Counter(r.sequence_id for r in got).values())


def test_a_repeated_id_is_one_sample(spark):
    many = spark.range(20_000).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("bad words "), F.col("id") % 3).alias("text"))
    docs = many.unionByName(spark.createDataFrame([(k, f"good words {k}") for k in range(2, 40)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    sample, prior = toxicity._sample(docs, labels, 1_000_000)
    rows = Counter((r.doc_id, r.positive) for r in sample.collect())
    assert rows[1, True] == 1 and max(rows.values()) == 1 and 0 < prior < 0.9


def test_quotes_inside_attributes_lose_no_text():
    page = "<article><p>One <a title=it's>two</a> three.</p><p data-x = 'a>b' title=\"c>d\">Four, five \"six\".</p><p class=x'y\"z>Seven.</p></article>"
    assert extraction.main_text(page) == "One two three.\nFour, five \"six\".\nSeven."
