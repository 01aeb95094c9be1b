"""Run registered queries next to their SQL and compare whole results.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_value(r[n]) for n in names) for r in df.collect()]
    return names, dict(df.dtypes), sorted(rows, key=repr)


def duck_rows(con, sql):
    cur = con.execute(sql)
    description = cur.description
    fetched = cur.fetchall()
    position = {d[0]: i for i, d in enumerate(description)}
    names = sorted(position)
    rows = [tuple(_value(r[position[n]]) for n in names) for r in fetched]
    return names, {d[0]: str(d[1]).lower() for d in description}, sorted(rows, key=repr)


SAME = {"string": "varchar", "int": "integer"}


def difference(spark_df, con, sql) -> str | None:
    """What differs, or None."""
    names, types, rows = spark_rows(spark_df)
    o_names, o_types, o_rows = duck_rows(con, sql)
    if names != o_names:
        return f"columns {names} != {o_names}"
    for n in names:
        if SAME.get(types[n], types[n]) != o_types[n]:
            return f"type of {n}: {types[n]} != {o_types[n]}"
    if len(rows) != len(o_rows):
        return f"{len(rows)} rows != {len(o_rows)}: {list(set(rows) ^ set(o_rows))[:4]}"
    if rows != o_rows:
        a, b = set(rows) - set(o_rows), set(o_rows) - set(rows)
        return f"{len(a)} of {len(rows)} rows differ: {sorted(a, key=repr)[:2]} != {sorted(b, key=repr)[:2]}"
    return None


def main() -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from themelake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = run(spark, sf_dir)
            found = difference(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:700]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - began:.1f}s {found or ''}", flush=True)
    print(bad, "differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
