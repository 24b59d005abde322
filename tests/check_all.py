"""Check all named queries against their SQL: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duck  # noqa: E402

from comanda.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problems = compare(df, con, sqls[name])
                n = "" 
            else:
                n = df.count()
                problems = []
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        kind = "sql" if name in sqls else f"rows only {n}"
        print(f"{'FAIL' if problems else 'ok  '} {name} ({kind}) {time.time() - start:.2f}s", flush=True)
        for p in problems:
            print("   ", p)
    print(f"{len(names) - bad} of {len(names)} agree")
    print("SQL without query:", sorted(set(sqls) - set(queries)))
    return bad


if __name__ == "__main__":
    sys.exit(main())
