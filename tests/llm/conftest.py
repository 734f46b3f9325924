import pytest
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("fail_bits", T.LongType()),
        T.StructField("n_lines", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)


def _words(a, n, tag="w"):
    return " ".join(f"{tag}{(a * 7919 + k * k * 31 + k) % 9973}" for k in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and white texts, equal rows, copies, near copies, a very long text, unusual characters."""
    base, passage = _words(1, 200), _words(5, 60, "p")
    near = base.split()
    near[100] = "other"
    long = "\n".join(_words(k, 15) for k in range(20, 2020))
    data = [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, " \t\n\x0b\x0c\r "),
        (7, "One two"),
        (8, "one TWO"),
        (9, f"{_words(6, 12)}\n{passage}\n{_words(7, 20)}"),
        (10, f"{_words(8, 20)}\n{passage}\n\n{_words(9, 11)}"),
        (11, long),
        (12, "ÄÖ  x é 　 b <|endoftext|> İ 'll don't"),
        (None, _words(3, 40)),
        (None, None),
        (13, _words(4, 30)),
        (13, _words(4, 30)),
        (14, "a a a a a a a a a a a a"),
        (15, "### $$$ %%% &&& *** ||| <<< >>> ### $$$ %%%"),
    ]
    return [(i, t, None if k % 7 == 3 else f"s{k % 4}", -1, -1, "x", "y") for k, (i, t) in enumerate(data)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
