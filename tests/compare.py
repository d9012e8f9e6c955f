"""Compare a Spark result with the SQL counterpart, as multisets of rows over columns sorted by name."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short account of what differs."""
    left_columns, left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    right_columns, right = rows_of([d[0] for d in result.description], result.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} against {right_columns}"
    if left != right:
        extra, lacking = left - right, right - left
        return (f"{sum(left.values())} rows against {sum(right.values())}; only in Spark {sum(extra.values())}: "
                f"{list(extra)[:2]}; only in SQL {sum(lacking.values())}: {list(lacking)[:2]}")
    return None
