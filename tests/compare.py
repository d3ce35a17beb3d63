"""Run registered queries and their SQL side by side.

    python tests/compare.py [sf_dir] [query ...]
"""

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TESTDATA = "/root/testdata"


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    body = sorted((tuple(row[i] for i in order) for row in rows), key=repr)
    return names, body


def compare(spark, con, name, sf_dir, query, sql):
    """None when equal, otherwise what differs."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference\n  {a}\n  {b}"
    return None if got[1] else "no rows on either side"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from footfall.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else f"{TESTDATA}/sf0.001"
    spark, con = local_session("8"), connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    print("no sql:", sorted(set(queries) - set(sqls)), "no query:", sorted(set(sqls) - set(queries)))
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, queries[name], sqls[name])
        except Exception as error:  # keep going, report at the end
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s", problem or "", flush=True)
    print("bad:", bad, "of", len(sys.argv[2:] or queries))
