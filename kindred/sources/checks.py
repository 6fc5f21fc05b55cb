"""Row-count checks on loaded tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, tuple[DataFrame, int | Column]]) -> DataFrame:
    """``(table_name, n_rows, expected, ok)`` for ``{name: (table, expected)}``.

    ``expected`` is a number or a scalar subquery. Every column of every row is computed, so a line that cannot be parsed
    fails the check.
    """
    counted = [
        # The hash of a row is not 0, but to know that, it must be computed.
        df.agg(F.count(F.nullif(F.xxhash64(*df.columns), F.lit(0))).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            (expected if isinstance(expected, Column) else F.lit(expected)).cast("long").alias("expected"),
        )
        for name, (df, expected) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).withColumn("ok", F.col("n_rows") == F.col("expected"))


def require_row_counts(tables: dict[str, tuple[DataFrame, int | Column]]) -> None:
    """Fail with a message if any table does not have the expected number of rows."""
    bad = row_counts(tables).where(~F.col("ok")).collect()
    if bad:
        raise ValueError("; ".join(f"invalid {r.table_name}: {r.n_rows} rows, expected {r.expected}" for r in bad))
