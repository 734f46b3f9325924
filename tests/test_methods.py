"""Plans whose generated methods the JVM compiles."""

import datetime as dt

import pytest

from clearspan import session
from clearspan.catalogue import interchange, reports

#: The JVM interprets methods of more bytes than this, row by row.
COMPILED_BYTES = 8000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few rows of the tables that transactions are made of."""
    day, place = dt.datetime(1998, 1, 5), str(tmp_path_factory.mktemp("tables"))
    tables = {
        "region": ("r_regionkey bigint, r_name string", [(i, f"R{i}") for i in range(5)]),
        "nation": ("n_nationkey bigint, n_name string, n_regionkey bigint", [(i, f"N{i}", i % 5) for i in range(25)]),
        "customer": ("c_custkey bigint, c_mktsegment string", [(i, ["AUTOMOBILE", "FURNITURE"][i % 2]) for i in range(4)]),
        "supplier": ("s_suppkey bigint, s_nationkey bigint", [(i, i % 25) for i in range(10)]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string, o_orderstatus string",
            [(i, i % 4, day, "1-URGENT", "O") for i in range(20)],
        ),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
            [(i // 2, i * 5 % 200, i % 10, i % 2 + 1, 5.0, 1000.0 + i, 0.02, 0.01, "A", "OF"[i % 2], day) for i in range(40)],
        ),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{place}/{name}.parquet")
    return place


@pytest.fixture
def fixed_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def longest_method(df):
    """Bytes of the longest generated method of a plan."""
    parts = df._jdf.queryExecution().debug().codegenToSeq()
    return max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))


@pytest.mark.parametrize("query", [reports.analytics_online, reports.reconcile_daily_online, interchange.interchange_fee_online])
def test_generated_methods_are_compiled(spark, folder, fixed_plans, query):
    assert longest_method(query(spark, folder)) <= COMPILED_BYTES


def test_lookups_of_the_bitmap_book_share_methods(spark, folder, fixed_plans):
    """Rows are written out where a method ends: after the transaction, its card, its attributes, its scope and its lookups."""
    fees = interchange.interchange_fee_bitmap(spark, folder)
    assert fees._jdf.queryExecution().optimizedPlan().toString().count("Repartition 1000000") <= 5
    assert longest_method(fees) <= COMPILED_BYTES


@pytest.mark.parametrize("query", [reports.analytics_text, reports.analytics_bitmap])
def test_methods_of_views_without_shuffles_are_compiled(spark, folder, fixed_plans, query):
    view = query(spark, folder)
    assert longest_method(view) <= COMPILED_BYTES
    # rows meet their fees only: neither customers nor rules shuffle them
    assert view._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") <= 1


@pytest.mark.parametrize("query", [reports.analytics_text, reports.analytics_online, reports.analytics_bitmap])
def test_views_in_steps_have_the_same_rows(spark, folder, monkeypatch, query):
    whole = sorted(map(str, query(spark, folder).collect()))
    monkeypatch.setattr(session, "STEP_ROWS", 8)
    cut = query(spark, folder)
    assert whole and sorted(map(str, cut.collect())) == whole
    # the joins are done and their shuffle files gone
    assert "Join" not in cut._jdf.queryExecution().optimizedPlan().toString()
