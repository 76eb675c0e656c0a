from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, name: str) -> str:
    """``name`` with underscores until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def evenly(df: DataFrame) -> DataFrame:
    """``df`` dealt to as many tasks as the session shuffles to, before work that costs far more than its rows weigh: Spark
    puts small partitions together by their bytes, but leaves a number that is given."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Rows for a task where ``dealt`` deals.
ROWS_PER_TASK = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by a hash of ``keys`` to as many tasks as ``rows`` rows need, before sorts and hash maps that keep rows
    of a few bytes on disk at hundreds of bytes each: Spark puts partitions together by their bytes."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)), *keys)
