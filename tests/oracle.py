"""Compare the registered queries with their SQL. As a script: folder and query names."""

import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return type(value).__name__
    return "int" if isinstance(value, int) else type(value).__name__


def compare(spark, con, folder, fn, sql):
    """None if equal, else a short text of the first difference."""
    df = fn(spark, folder)
    names = sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    at = [columns.index(n) for n in names]
    want = [tuple(r[i] for i in at) for r in result.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows, {len(want)} wanted"
    if not got:
        return "no rows"

    def key(row):
        return tuple((v is not None, str(v)) for v in row)

    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        if a != b or list(map(kind, a)) != list(map(kind, b)):
            return f"{dict(zip(names, a))}\n != {dict(zip(names, b))}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder, wanted = sys.argv[1], sys.argv[2:]
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, fn, sqls.get(name))
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        label = "ok" if problem is None else "BAD"
        print(f"{label:4}{name:28}{time.time() - start:7.2f}s", "" if name in sqls else "(rows only)",
              problem or "", flush=True)
    print("bad:", bad)
