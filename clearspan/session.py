"""Session construction and reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Steps that a join of many wide rows is done in at most, and the rows of a step, about.
MAX_STEPS = 8
STEP_ROWS = 1_000_000
#: Types whose equal values have equal hashes.
_CUT_BY = ("boolean", "tinyint", "smallint", "int", "bigint", "date", "string")

#: Drops the shuffle files of a query when it ends, not when the driver happens to collect garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "clearspan", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on.

    AQE re-plans joins and partition counts from run-time sizes, so no shuffle
    width is fixed here; pass one through ``conf`` for small local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    master without that setting falls back to a scratch folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="clearspan-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind. For writes, whose plan is not run again."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def written(df: DataFrame, *more: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, or a new ``folder``, as compressed columns, and read it from there.

    Smaller than a checkpoint, which stores whole rows as they are; partitions are not kept. ``more`` rows of the same
    columns are added one after another, so the disk holds the shuffle files of one DataFrame at a time.
    """
    spark = df.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark)}/rows-{uuid.uuid4().hex}"
    # a column without a type holds nothing and is not stored
    void = {f.name: F.lit(None) for f in df.schema if f.dataType.typeName() == "void"}
    kept = df.drop(*void)
    with shuffles_dropped(spark):
        for part in (kept, *[m.select(*kept.columns) for m in more]):
            part.write.option("compression", "zstd").mode("append").parquet(folder)
    return spark.read.schema(kept.schema).parquet(folder).withColumns(void).select(*df.columns)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of rows that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def steps_for(rows: int) -> int:
    """Steps for a join of so many rows."""
    return max(1, min(MAX_STEPS, rows // STEP_ROWS))


def slice_of(keys: Sequence[str | Column], slices: int) -> Column:
    """Number of the slice that rows with these keys lie in; equal keys of equal types share it, nulls too."""
    return F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int")


def slices(sides: Sequence[DataFrame], keys: Sequence[str], steps: int) -> list[list[DataFrame]]:
    """The tables cut into ``steps``: rows that are equal in all ``keys`` lie in the same.

    Keys that could be equal without having the same hash (other types, fractions) are not cut by; without any other, there
    is one slice.
    """
    types = [[dict(side.dtypes)[k] for side in sides] for k in keys]
    plain = [k for k, t in zip(keys, types, strict=True) if len({*t}) == 1 and t[0] in _CUT_BY]
    if steps == 1 or not plain:
        return [[*sides]]
    return [[side.filter(slice_of(plain, steps) == n) for side in sides] for n in range(steps)]


def in_steps(step: Callable[..., DataFrame], sides: Sequence[DataFrame], keys: Sequence[str], steps: int) -> DataFrame:
    """``step`` of tables whose rows meet only where all ``keys`` are equal, done for one slice of the keys at a time.

    The rows of a step are stored before the next one begins, so the disk holds the shuffle files of one slice. The tables are
    read once for each step: they should be stored, and their keys be stored columns.
    """
    done = [step(*some) for some in slices(sides, keys, steps)]
    return done[0] if len(done) == 1 else written(*done)
