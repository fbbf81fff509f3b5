"""Compare registered queries with their SQL on the same tables.

``python tests/oracle.py <folder> [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "tzinfo"):
        return value.replace(tzinfo=None).isoformat(" ")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "asDict"):
        return _plain(value.asDict())
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


TYPES = {"LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR", "BooleanType": "BOOLEAN",
         "IntegerType": "INTEGER"}


def compare(spark, con, name, query, sql, sf_dir) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    start = time.time()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    want = result.fetchall()
    note = f"{len(got)} rows, spark {took:.1f}s, sql {time.time() - start:.1f}s"
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    for field in df.schema:
        kind = TYPES.get(type(field.dataType).__name__)
        if kind and types[field.name] != kind:
            return False, f"type of {field.name}: {kind} vs {types[field.name]}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}; {note}"
    differ = [(x, y) for x, y in zip(a, b) if x != y]
    if differ:
        return False, f"{len(differ)} differ of {len(a)}, first (columns {sorted(columns)}):\n   {str(differ[0][0])[:600]}\n   {str(differ[0][1])[:600]}"
    return True, note


def main(argv: list[str]) -> None:
    import __spark_entry__ as entry
    from plumbline.session import build_session

    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = argv[0], argv[1:]
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = connect(sf_dir)
    bad = []
    for name in names or queries:
        try:
            if name in oracles:
                ok, note = compare(spark, con, name, queries[name], oracles[name], sf_dir)
            else:
                start = time.time()
                n = len(queries[name](spark, sf_dir).collect())
                ok, note = True, f"{n} rows, no SQL, {time.time() - start:.1f}s"
        except Exception as error:  # report and go on with the next query
            ok, note = False, str(error)[:1500]
        if not ok:
            bad.append(name)
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
