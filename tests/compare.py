"""Compare a Spark result with its SQL oracle: column names, types and the multiset of rows."""

from __future__ import annotations

from collections import Counter

import duckdb
import pyarrow as pa

TABLES = ("events", "lineitem", "orders", "customer", "supplier", "part", "nation", "region")


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    return Counter(zip(*[[repr(v) for v in table.column(name).to_pylist()] for name in names]))


def _types(table: pa.Table) -> dict[str, str]:
    plain = {"large_string": "string"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in table.schema}


def differences(spark_table: pa.Table, oracle_table: pa.Table) -> list[str]:
    found = []
    if _types(spark_table) != _types(oracle_table):
        found.append(f"types {_types(spark_table)} != {_types(oracle_table)}")
    if sorted(spark_table.column_names) == sorted(oracle_table.column_names):
        ours, theirs = _rows(spark_table), _rows(oracle_table)
        if ours != theirs:
            found.append(
                f"rows {ours.total()} vs {theirs.total()}; only ours {list((ours - theirs).items())[:3]}; "
                f"only oracle {list((theirs - ours).items())[:3]}"
            )
    return found
