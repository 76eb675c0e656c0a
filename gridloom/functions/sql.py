"""Functions for use in SQL text: scalar ones as SQL, and a table function that takes a whole table.

``register(spark)`` makes them known to the session. Scalar functions are expressions that Catalyst puts into the query;
the table function gets its table partitioned and sorted by Spark, as its ``analyze`` asks for, and reads it row by row
with the state of one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf

#: Name, parameters, result and body of each scalar function.
SCALARS = (
    ("url_domain", "url STRING", "STRING", r"regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, r'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), r':\d*$', ''), r'^www\.', '')"),
    ("days_apart", "a DATE, b DATE", "INT", "abs(datediff(a, b))"),
    ("first_int", "text STRING", "BIGINT", r"try_cast(nullif(regexp_extract(text, r'\d+', 0), '') AS BIGINT)"),
    ("text_excerpt", "text STRING, word STRING, before INT, after INT", "STRING", "CASE WHEN instr(text, word) > 0 THEN substring(text, greatest(1, instr(text, word) - before), least(instr(text, word) - 1, before) + length(word) + after) END"),
)


def _argument(value: AnalyzeArgument, name: str) -> str:
    if value.isTable or not isinstance(value.value, str):
        raise ValueError(f"{name} is the name of a column, as text")
    return value.value


@udtf
class ChangeRuns:
    """Runs of rows in which a column keeps its value: ``change_runs(TABLE(t), key, order, value)``.

    For every key, in the order of a column: the key, the value, the first and the last place of the run, and its rows.
    Nulls are a value like any other.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, value: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable:
            raise ValueError("the first argument is a table")
        names = [_argument(a, n) for a, n in ((key, "key"), (order, "order"), (value, "value"))]
        fields = {f.name: f.dataType for f in table.dataType.fields}
        if missing := [n for n in names if n not in fields]:
            raise ValueError(f"no column {', '.join(missing)}")
        k, o, v = names
        schema = T.StructType([T.StructField(k, fields[k]), T.StructField(v, fields[v]), T.StructField("run_start", fields[o]), T.StructField("run_end", fields[o]), T.StructField("n_rows", T.LongType())])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(k)], orderBy=[OrderingColumn(o)])

    def __init__(self) -> None:
        self.run: list[Any] | None = None

    def eval(self, table: Row, key: str, order: str, value: str) -> Iterator[tuple]:
        if self.run and self.run[1] == table[value]:
            self.run[3], self.run[4] = table[order], self.run[4] + 1
            return
        if self.run:
            yield tuple(self.run)
        self.run = [table[key], table[value], table[order], table[order], 1]

    def terminate(self) -> Iterator[tuple]:
        if self.run:
            yield tuple(self.run)


def register(spark: SparkSession) -> None:
    for name, parameters, result, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    spark.udtf.register("change_runs", ChangeRuns)
