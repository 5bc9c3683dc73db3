"""Side-by-side comparison of a Spark query and its SQL on the same tables."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _family(kind):
    kind = str(kind).lower()
    for family, names in {
        "int": ("tinyint", "smallint", "int", "bigint", "integer", "long", "hugeint"),
        "float": ("double", "float"), "text": ("string", "varchar"),
        "time": ("timestamp_ntz", "timestamp"), "bool": ("boolean",), "date": ("date",),
    }.items():
        if kind in names:
            return family
    return kind


def _key(row):
    return [(value is not None, str(type(value)), value if value is not None else 0)
            for value in row]


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def differences(df, con, sql):
    """Empty when names, type families, row counts and all values agree exactly."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    spark_types = {n: _family(t) for n, t in df.dtypes}
    sql_types = {n: _family(t) for n, t in zip(relation.columns, relation.types)}
    found = [f"type of {n}: {spark_types[n]} != {sql_types[n]}"
             for n in names if spark_types[n] != sql_types[n]]
    ours = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    order = [relation.columns.index(n) for n in names]
    theirs = [tuple(row[i] for i in order) for row in relation.fetchall()]
    if len(ours) != len(theirs):
        return found + [f"{len(ours)} rows != {len(theirs)} rows"]
    for a, b in zip(sorted(ours, key=_key), sorted(theirs, key=_key)):
        if not all(_same(x, y) for x, y in zip(a, b)):
            found.append(f"{dict(zip(names, a))} != {dict(zip(names, b))}")
    return found
