"""Steps that must not grow faster than their input: work done twice, rows moved twice, files of one task."""

from pyspark.sql import functions as F

from clearspan.catalogue import inputs
from clearspan.catalogue.streams import FILE_ROWS, file_share
from clearspan.operators.skew import chunked_scan, global_row_number
from clearspan.plans.calculated import _customer
from clearspan.session import in_steps, shuffles_dropped, slices, written
from clearspan.sources import messages

_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_numbering_moves_rows_once(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(None).alias("void"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    out = global_row_number(rows, [F.col("k")], "n", 5)
    assert out.columns == ["k", "void", "v", "n"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "Repartition" not in plan
    assert sorted((r.k, r.n) for r in out.collect()) == [(i, i + 5) for i in range(1000)]
    assert out.filter("void IS NOT NULL").count() == 0


def test_written_rows_come_back(spark):
    rows = spark.createDataFrame([(1, None, [1, None]), (None, "x", None), (1, None, [1, None])], "a int, b string, c array<int>")
    assert sorted(map(str, written(rows).collect())) == sorted(map(str, rows.collect()))


def test_shuffle_files_are_dropped_only_inside(spark):
    before = spark.conf.get(_DROP, None)
    with shuffles_dropped(spark):
        assert spark.conf.get(_DROP) == "true"
    assert spark.conf.get(_DROP, None) == before


def test_messages_are_decoded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(pdfs):
        for pdf in pdfs:
            seen.add(len(pdf))
            yield pdf

    head = [("f", 1, "1644", "697", "0105012002240131"), ("f", 2, "1240", "", ""), ("g", 1, "1240", "", "")]
    rows = spark.createDataFrame(head, "path string, record_no bigint, MESSAGE_TYPE string, DE24 string, DE48 string")
    out = messages.with_file_date(rows.mapInPandas(counted, rows.schema)).collect()
    assert {(r.path, r.record_no): r.app_file_date for r in out} == {("f", 1): "240131", ("f", 2): "240131", ("g", 1): "000101"}
    assert seen.value == 3


def test_files_grow_in_number_not_in_size():
    assert file_share(0) == file_share(6 * FILE_ROWS) == 1
    assert file_share(6 * FILE_ROWS + 1) == 2
    assert file_share(600 * FILE_ROWS) == 100


def test_fact_parts_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    rows = [(i // 2, i % 2) for i in range(40)] + [(None, 1), (3, 1)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(inputs, "TASK_ROWS", 4)
    parts = inputs.Source(spark, str(tmp_path)).lineitem
    assert parts.rdd.getNumPartitions() == 11
    assert sorted(map(str, parts.collect())) == sorted(map(str, spark.createDataFrame(rows, parts.schema).collect()))


def test_customers_do_not_shuffle_transactions(spark):
    money = spark.createDataFrame([("USD", 840), ("EUR", 978)], "currency_alphabetic_code string, currency_numeric_code int")
    names = ["code", "acquiring_bins", "issuing_bins_6_digits", "issuing_bins_8_digits", "local_currency_code", "settlement_currency_code"]
    customers = spark.createDataFrame([("A", "1", "2", "3", "USD", "EUR"), ("B", None, None, None, "GBP", None)], ", ".join(f"{n} string" for n in names))
    rows = spark.range(100).select(F.when(F.col("id") % 3 > 0, F.lit("A")).alias("c"))
    joined = rows.join(_customer(customers, money), F.col("c") == F.col("_code"), "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [c#" in plan and joined.filter("_local_num = 840 AND _settle_num = 978").count() == 66


def test_slices_hold_rows_that_meet(spark):
    left = spark.createDataFrame([(i % 5 if i % 4 else None, f"x{i % 3}", i) for i in range(60)], "a int, b string, v int")
    right = spark.createDataFrame([(i % 5 if i else None, f"x{i % 2}", i) for i in range(20)], "a int, b string, w int")
    step = lambda x, y: x.join(y, ["a", "b"], "left")
    whole = sorted(map(str, step(left, right).collect()))
    cut = in_steps(step, [left, right], ["a", "b"], 4)
    assert "Join" not in cut._jdf.queryExecution().optimizedPlan().toString() and sorted(map(str, cut.collect())) == whole
    # equal numbers of different types have different hashes: only the text is cut by
    other = right.withColumn("a", F.col("a").cast("bigint"))
    assert sorted(map(str, in_steps(step, [left, other], ["a", "b"], 4).collect())) == whole
    assert len(slices([left.select("a"), other.select("a")], ["a"], 4)) == 1


def test_numbering_in_steps(spark):
    rows = written(spark.createDataFrame([(None if i % 9 == 0 else "k" * (i % 3) + str(i % 13), i) for i in range(300)], "k string, v int"))
    order = [F.asc_nulls_first("k"), F.asc_nulls_first("v")]
    assert sorted(map(str, global_row_number(rows, order, "n", by="k", steps=5).collect())) == sorted(map(str, global_row_number(rows, order, "n").collect()))
    same = written(rows.withColumn("k", F.lit(None).cast("string")))
    assert sorted(r.n for r in global_row_number(same, order, "n", by="k", steps=5).collect()) == list(range(1, 301))


def test_scan_in_steps(spark):
    rows = spark.createDataFrame([(i % 3 if i % 11 else None, i // 20, i, i % 4 == 0) for i in range(240)], "f bigint, piece bigint, pos bigint, start boolean")
    args = ["f"], "piece", ["pos"], {"n": F.col("start").cast("int")}, {"last": F.when(F.col("start"), F.col("pos"))}, {"least": F.col("pos")}
    cut = chunked_scan(rows, *args, steps=4)
    assert "Window" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, cut.collect())) == sorted(map(str, chunked_scan(rows, *args).collect()))


def test_stored_inputs_are_used_by_others(spark, tmp_path):
    spark.createDataFrame([(1, 2), (None, 3), (1, 2)], "l_orderkey bigint, l_partkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    s = inputs.Source(spark, str(tmp_path)).stored("lineitem")
    assert sorted(map(str, s.sql("SELECT * FROM {lineitem} l").collect())) == sorted(map(str, s.lineitem.collect()))
    assert s.lineitem.count() == 3 and s.folders["lineitem"].rsplit("/", 1)[1] in s.lineitem.inputFiles()[0] and s.steps("lineitem") == 1
