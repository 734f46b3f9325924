"""Keep generated code small enough for the JVM to compile."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: More partitions than any job has: the call below never merges partitions.
NO_LIMIT = 1_000_000


def end_generated_code(df: DataFrame) -> DataFrame:
    """Same rows and partitions, but the generated method of the stage ends here.

    Spark fuses consecutive projections and broadcast joins into one method. Long
    chains of card expressions make it too long for the JVM's compiler, which then
    interprets it row by row. A coalesce to a huge number moves no data; it only
    starts a new method.
    """
    return df.coalesce(NO_LIMIT)
