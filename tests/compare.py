"""Run a query and its SQL check on the same tables and compare whole results."""

import glob
import math
import os

import duckdb

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sortable(row):
    return tuple((v is None, str(type(v)), 0 if v is None else v) for v in row)


def differences(df, con, sql):
    """A description of the first difference, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]}
    if wrong:
        return f"types {wrong}"
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in expected), key=_sortable)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=_sortable)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b and not _both_nan(a, b)]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def _both_nan(a, b):
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))
