"""Run SQL in DuckDB over the sample tables and compare it with a Spark result."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def duck_rows(folder: str, sql: str):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    table = con.sql(sql).to_arrow_table()
    con.close()
    return table


def _types(table) -> dict[str, str]:
    names = {"timestamp[ns]": "timestamp", "timestamp[us]": "timestamp", "large_string": "string"}
    out = {}
    for f in table.schema:
        kind = str(f.type).replace("decimal128", "decimal")
        out[f.name] = names.get(kind, kind)
    return out


def _bag(table) -> Counter:
    columns = sorted(table.column_names)
    lists = [table.column(c).to_pylist() for c in columns]
    return Counter(zip(*lists))


def differences(spark_df, duck_table) -> list[str]:
    """What differs between the two results, in column names, types, rows."""
    mine = spark_df.toArrow()
    found = []
    if _types(mine) != _types(duck_table):
        found.append(f"types {_types(mine)} != {_types(duck_table)}")
    if sorted(mine.column_names) != sorted(duck_table.column_names):
        return found
    left, right = _bag(mine), _bag(duck_table)
    if left != right:
        only_left, only_right = left - right, right - left
        found.append(
            f"rows {sum(left.values())} vs {sum(right.values())}; only spark "
            f"{sum(only_left.values())}: {list(only_left)[:3]}; only sql "
            f"{sum(only_right.values())}: {list(only_right)[:3]}"
        )
    return found
