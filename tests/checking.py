"""Compare a query with its SQL twin: names, types and the bag of values."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connection(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def kind(field_type: pa.DataType) -> str:
    if pa.types.is_large_string(field_type) or pa.types.is_string(field_type):
        return "string"
    return str(field_type)


def rows(table: pa.Table):
    columns = sorted(table.column_names)
    values = [table.column(c).to_pylist() for c in columns]
    return columns, sorted(zip(*values), key=repr)


def compare(spark_df, con, sql):
    """Return a list of differences, empty if the two agree."""
    ours, theirs = spark_df.toArrow(), con.execute(sql).to_arrow_table()
    problems = []
    types = [{f.name: kind(f.type) for f in t.schema} for t in (ours, theirs)]
    if types[0] != types[1]:
        problems.append(f"schema {sorted(types[0].items())} / {sorted(types[1].items())}")
        if set(types[0]) != set(types[1]):
            return problems
    (_, left), (_, right) = rows(ours), rows(theirs)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    if left != right:
        a, b = set(map(repr, left)), set(map(repr, right))
        problems.append(f"only here {sorted(a - b)[:3]}, only there {sorted(b - a)[:3]}")
    if not left:
        problems.append("no rows")
    return problems
