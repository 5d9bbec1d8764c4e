"""Run registered queries beside their SQL in DuckDB: ``python tests/compare.py SF_DIR [name...]``."""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(con, sql, rows, columns):
    """None when both sides agree on column names and on the sorted rows."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != sorted(columns):
        return f"columns {sorted(columns)} instead of {sorted(names)}"
    at = [names.index(c) for c in sorted(columns)]
    expected = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)
    here = [list(columns).index(c) for c in sorted(columns)]
    found = sorted((tuple(r[i] for i in here) for r in rows), key=repr)
    if len(expected) != len(found):
        return f"{len(found)} rows instead of {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return f"{a} instead of {b}"
    return None if found else "no rows"


def main(sf_dir, names):
    import __spark_entry__ as driver
    from rowgate.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, run in driver.queries().items():
        if (names and name not in names) or name not in driver.oracle_sql():
            continue
        start = time.time()
        df = run(spark, sf_dir)
        built = time.time()
        rows = df.collect()
        problem = difference(con, driver.oracle_sql()[name], rows, df.columns)
        bad += problem is not None
        print(f"{name:30s} {built - start:6.2f} {time.time() - built:6.2f} {len(rows):8d} {problem or 'ok'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
