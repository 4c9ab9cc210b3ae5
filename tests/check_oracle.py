"""Run registered queries in Spark and DuckDB over one data folder and compare.

    python tests/check_oracle.py [folder] [query ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    import math

    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(float(value)) if isinstance(value, float) else str(value)


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in data)


def differences(spark_df, con, sql, show=3):
    """Empty when columns, types of columns and all rows agree."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    out = []
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} / {sorted(columns)}"]
    kinds = {"bigint": int, "int": int, "double": float, "string": str}
    for field in spark_df.schema:
        kind = kinds[field.dataType.simpleString()]
        i = columns.index(field.name)
        wrong = [r[i] for r in expected if r[i] is not None and type(r[i]) is not kind]
        if wrong:
            out.append(f"type of {field.name}: {field.dataType.simpleString()} / {type(wrong[0])}")
    rows = spark_df.collect()
    if not rows or not expected:
        out.append("no rows")
    got, want = _rows(spark_df.columns, rows), _rows(columns, expected)
    if got != want:
        only_got = list(set(got) - set(want))
        only_want = list(set(want) - set(got))
        out.append(f"rows {len(got)} / {len(want)}, unlike {len(only_got)} / {len(only_want)}")
        out += [f"spark {sorted(only_got)[:show]}", f"duckdb {sorted(only_want)[:show]}"]
    return out


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from crowdtide.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in sys.argv[2:] or queries():
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            found = differences(df, con, oracle_sql()[name])
        except Exception as error:  # report and go on to the next query
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found)
        print(f"CHECK {'FAIL' if found else 'ok'} {name} {time.time() - start:.1f}s", *found, sep="\n    ", flush=True)
    print("CHECK failed:", bad)
