"""Compare a registered query with its SQL, as the driver does: names, rows, types, values."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind):
        return "string"
    if pa.types.is_timestamp(kind):
        return "timestamp"
    return str(kind)


def _rows(table: pa.Table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]

    def key(row):
        return tuple((v is None, type(v).__name__, str(v)) for v in row)

    def clean(v):
        if isinstance(v, float):
            if math.isnan(v):
                return "NaN"
            return v + 0.0
        return v

    return sorted((tuple(clean(v) for v in row) for row in zip(*columns)), key=key)


def compare(spark_table: pa.Table, oracle_table: pa.Table) -> list[str]:
    problems = []
    a, b = sorted(spark_table.column_names), sorted(oracle_table.column_names)
    if a != b:
        return [f"columns {a} != {b}"]
    for n in a:
        x, y = (_plain(t.schema.field(n).type) for t in (spark_table, oracle_table))
        if x != y:
            problems.append(f"type of {n}: {x} != {y}")
    if spark_table.num_rows != oracle_table.num_rows:
        problems.append(f"rows {spark_table.num_rows} != {oracle_table.num_rows}")
    left, right = _rows(spark_table), _rows(oracle_table)
    if left != right:
        different = [(x, y) for x, y in zip(left, right) if x != y]
        problems.append(f"{len(different)} rows differ, first: {different[:1]} columns {a}")
    return problems


def main() -> int:
    from brackish.plans.registry import ORACLES, QUERIES, load_all
    from brackish.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    load_all()
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            got = run(spark, folder).toArrow()
            took = time.time() - start
            sql = ORACLES.get(name)
            problems = compare(got, con.execute(sql).to_arrow_table()) if sql else []
            note = "ok" if sql else "rows only"
        except Exception as error:  # report every query
            took, problems, note = time.time() - start, [f"{type(error).__name__}: {str(error)[:1500]}"], ""
            got = None
        bad += bool(problems)
        print(f"{name:28s} {took:6.2f}s {got.num_rows if got is not None else '-':>8} {'; '.join(problems)[:1800] if problems else note}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
