"""Tables of a few values that are known on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """One or more rows as SQL literals; unlike ``createDataFrame`` this starts no Python worker."""
    columns = T.StructType.fromDDL(schema)
    # Named, because Spark 4.1 binds positional parameters in VALUES in another order.
    values = {f"v{i}": value for i, value in enumerate(v for row in rows for v in row)}
    names = iter(values)
    places = ", ".join(f"({', '.join(f':{next(names)}' for _ in row)})" for row in rows)
    given = spark.sql(f"SELECT * FROM VALUES {places} AS t({', '.join(columns.names)})", values)
    return given.to(columns)
