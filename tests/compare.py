"""Compare registered queries with their SQL in DuckDB.

As a script: ``python -m tests.compare FOLDER [NAME ...]``.
"""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def difference(db, frame, sql):
    """None if frame and SQL agree in names, types and rows; else a text."""
    cursor = db.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    kinds = dict(frame.dtypes)
    wanted = {n: KINDS.get(k.upper(), k) for n, k in described.items()}
    if kinds != wanted:
        return f"types {kinds} instead of {wanted}"
    got = frame.collect()
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    mine, theirs = _rows(frame.columns, got), _rows(list(described), expected)
    apart = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(apart)} rows differ, first {apart[0]}" if apart else None


def main(folder, names):
    from __spark_entry__ import oracle_sql, queries
    from ridecells.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db, sql = connect(folder), oracle_sql()
    wrong = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, folder)
            if name in sql:
                result = difference(db, frame, sql[name])
            else:
                result = f"-- rows only: {frame.count()}"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += result is not None and not result.startswith("--")
        print(f"{name:32} {time.time() - start:6.2f}s {result or 'ok'}", flush=True)
    print("wrong:", wrong)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
