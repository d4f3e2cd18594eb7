"""Compare a Spark frame with check SQL as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What is wrong, empty when the two agree in columns, types and rows."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    order = sorted(names)
    expected = Counter(tuple(row[names.index(c)] for c in order) for row in result.fetchall())
    found = Counter(tuple(row) for row in frame.select(*order).collect())
    problems = []
    if found != expected:
        problems.append(
            f"rows {sum(found.values())} != {sum(expected.values())}; "
            f"only Spark {list((found - expected).items())[:3]}; only SQL {list((expected - found).items())[:3]}"
        )
    for name, kind in frame.dtypes:
        problems += _type_problem(name, kind, types[name])
    return problems


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE",
}


def _type_problem(name: str, kind: str, sql_type: str) -> list[str]:
    wanted = SAME.get(kind, kind.upper())
    return [] if sql_type.replace(" ", "") == wanted else [f"{name}: {kind} against {sql_type}"]
