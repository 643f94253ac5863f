"""Compare registered queries with their SQL twins in DuckDB.

    python -m tests.oracle /root/testdata/sf0.01 [query ...]
"""

import glob
import os
import sys
import time

import duckdb

import __spark_entry__ as contract
from tallyloom.session import local_session

_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def difference(spark, con, sf_dir, name):
    """None where the query and its twin agree, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    mine = [tuple(r) for r in df.select(*columns).collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    con.execute(f"CREATE OR REPLACE TEMP TABLE twin AS {sql}")
    described = {r[0]: r[1] for r in con.execute("DESCRIBE twin").fetchall()}
    if sorted(described) != columns:
        return f"columns {columns} != {sorted(described)}"
    types = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    if types != described:
        return f"types { {c: (types[c], described[c]) for c in columns if types[c] != described[c]} }"
    theirs = con.execute(f"SELECT {', '.join(columns)} FROM twin").fetchall()
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    mine, theirs = sorted(mine, key=_key), sorted(theirs, key=_key)
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            return f"{columns}: {a} != {b}"
    return None


def main(sf_dir, names):
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names or contract.queries():
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name:26s} {time.time() - start:6.2f}s {found or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
