"""Run registered queries next to their SQL: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return [canonical(v) for v in value]
    if isinstance(value, dict):
        return {k: canonical(v) for k, v in value.items()}
    if hasattr(value, "asDict"):
        return canonical(value.asDict())
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((repr([canonical(r[i]) for i in order]) for r in rows))


def kind(value):
    return type(value).__name__


def plan_problems(df):
    """Operators that must not occur: joins without keys and row-wise Python."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [f"plan has {op}" for op in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas") if op in plan]


def check(spark, con, query, sql, folder):
    """Problems found, number of rows, seconds in Spark."""
    start = time.time()
    df = query(spark, folder)
    got = df.collect()
    seconds = time.time() - start
    problems = plan_problems(df)
    if sql is None:
        return problems + ([] if got else ["no rows"]), len(got), seconds
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns: only spark {set(df.columns) - set(names)}, only sql {set(names) - set(df.columns)}")
        return problems, len(got), seconds
    if not got:
        problems.append("no rows")
    if len(got) != len(want):
        problems.append(f"rows: spark {len(got)}, sql {len(want)}")
    a, b = rows_of(df.columns, [tuple(r) for r in got]), rows_of(names, want)
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        problems.append(f"values differ in {len(left)} / {len(right)} rows")
        problems.append(f"  columns {sorted(names)}")
        problems += [f"  spark {r}" for r in sorted(left)[:2]] + [f"  sql   {r}" for r in sorted(right)[:2]]
    types = dict(df.dtypes)
    sql_types = {c[0]: str(c[1]) for c in result.description}
    alike = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name in names:
        if types[name] in alike and alike[types[name]] != sql_types[name]:
            problems.append(f"type of {name}: spark {types[name]}, sql {sql_types[name]}")
    return problems, len(got), seconds


def main(argv):
    import __spark_entry__ as entry
    from eventrank.sources.session import local_session

    sf = argv[0] if argv else "0.01"
    folder = f"/root/testdata/sf{sf}"
    queries, sql = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    spark, con = local_session(8), duck(folder)
    bad = 0
    for name in names:
        try:
            problems, n, seconds = check(spark, con, queries[name], sql.get(name), folder)
        except Exception as error:  # report and go on with the next query
            problems, n, seconds = [f"{type(error).__name__}: {str(error)[:1500]}"], 0, 0.0
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name:32s} rows={n:6d} {seconds:6.2f}s {'' if name in sql else '(rows only)'}", flush=True)
        for p in problems:
            print("     ", p[:1500], flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
