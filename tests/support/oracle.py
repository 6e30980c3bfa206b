"""Run a query and its SQL oracle and compare the two results."""

from __future__ import annotations

import math

import duckdb

SQL_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "DOUBLE": "double",
             "VARCHAR": "string", "BOOLEAN": "boolean"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _row(values) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in values)


def compare(df, con, sql: str) -> dict:
    """Exact, order-insensitive comparison with the columns sorted by name."""
    columns = sorted(df.columns)
    spark_rows = [_row(r[c] for c in columns) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    raw = result.fetchall()
    report = {"columns": sorted(names) == columns, "spark": len(spark_rows), "sql": len(raw),
              "types": {c: (t, types.get(c)) for c, t in df.dtypes}}
    if report["columns"]:
        at = [names.index(c) for c in columns]
        sql_rows = [_row(r[i] for i in at) for r in raw]
        order = lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r)
        a, b = sorted(spark_rows, key=order), sorted(sql_rows, key=order)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        report["different"] = len(bad) + abs(len(a) - len(b))
        report["first"] = bad[:1]
    else:
        report["names"] = (columns, sorted(names))
    report["wrong_types"] = [c for c, (a, b) in report.pop("types").items()
                             if SQL_TYPES.get(b) != a]
    report["ok"] = (report["columns"] and not report["wrong_types"]
                    and report.get("different") == 0)
    return report
