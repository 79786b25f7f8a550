"""Run queries against their SQL: ``python tests/oracle.py [sf_dir] [key=value ...] [name ...]``.

Settings such as ``spark.sql.autoBroadcastJoinThreshold=-1`` show the plans that large tables get.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def database(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(arrow):
    columns = sorted(arrow.column_names)
    data = arrow.select(columns).to_pydict()
    rows = zip(*[[_cell(v) for v in data[c]] for c in columns]) if columns else []
    return sorted(rows, key=repr)


def _types(arrow):
    plain = {"large_string": "string", "string_view": "string", "timestamp[us, tz=UTC]": "timestamp[us]"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in arrow.schema}


def differences(spark_df, connection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL's: types, number of rows, first rows."""
    got = spark_df.toArrow()
    want = connection.sql(sql).to_arrow_table()
    found = []
    if _types(got) != _types(want):
        found.append(f"types {_types(got)} against {_types(want)}")
        if set(got.column_names) != set(want.column_names):
            return found
    mine, theirs = _rows(got), _rows(want)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows against {len(theirs)}")
    if mine != theirs:
        pairs = [(a, b) for a, b in zip(mine, theirs) if a != b][:3]
        found.append("rows " + "; ".join(f"{str(a)[:300]} against {str(b)[:300]}" for a, b in pairs))
    return found


def main():
    from verbatide import build_session
    from __spark_entry__ import REGISTERED

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **dict(arg.split("=", 1) for arg in args if "=" in arg),
    }
    args = [arg for arg in args if "=" not in arg]
    spark = build_session("oracle", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    bad = []
    for name in args or REGISTERED:
        query, start = REGISTERED[name], time.time()
        try:
            df = query.run(spark, sf_dir)
            if query.sql is None:
                count, found = df.count(), []
                note = f"{count} rows, no SQL"
            else:
                found, note = differences(df, connection, query.sql), ""
        except Exception as error:  # report and go on with the next query
            found, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        print(f"{'BAD' if found else 'ok ':4}{name:30}{time.time() - start:7.1f}s {note}", flush=True)
        for line in found:
            print("     ", line, flush=True)
        if found:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
