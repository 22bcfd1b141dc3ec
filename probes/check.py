"""Run every query on Spark and its SQL on DuckDB and compare the rows.

    python -m probes.check [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter

from creelgrid.session import build_session

from . import casting
from .queries import ORACLES, QUERIES


def plain(value):
    if value is None:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def as_tuples(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, duck, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    columns, ours = as_tuples(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if name not in ORACLES:
        return True, f"{sum(ours.values())} rows, {took:.1f}s, no SQL"
    rel = duck.sql(ORACLES[name])
    their_columns, theirs = as_tuples(rel.columns, rel.fetchall())
    note = f"{sum(ours.values())}/{sum(theirs.values())} rows, {took:.1f}s"
    odd = [f"{c} {t}" for c, t in zip(rel.columns, rel.types) if str(t).startswith(("DECIMAL", "HUGEINT"))]
    ours_by_name = dict(df.dtypes)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd += [
        f"{c} {ours_by_name.get(c)}/{t}" for c, t in zip(rel.columns, rel.types)
        if c in ours_by_name and kinds.get(ours_by_name[c]) != str(t)
    ]
    note += f" types {odd}" if odd else ""
    if columns != their_columns:
        return False, f"{note}; columns {columns} / {their_columns}"
    if ours != theirs:
        extra = list((ours - theirs).items())[:3]
        missing = list((theirs - ours).items())[:3]
        return False, f"{note}; {columns}\n   spark only {extra}\n   sql only {missing}"
    return True, note


def main() -> int:
    import duckdb

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for table in casting.SOURCES:
        duck.sql(f"create view {table} as select * from '{args.sf}/{table}.parquet'")
    failed = []
    for name in args.names or QUERIES:
        try:
            good, note = compare(spark, duck, name, args.sf)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        print("ok  " if good else "FAIL", name, note, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
