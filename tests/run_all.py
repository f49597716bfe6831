"""python tests/run_all.py [sf_dir] [query ...]: compare queries with their SQL, with times."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from scanlake.session import local_session  # noqa: E402
from tests.compare import differences, duck  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, queries = duck(sf_dir), entry.oracle_sql(), entry.queries()
    names = sys.argv[2:] or list(queries)
    wrong = 0
    for name in names:
        start = time.time()
        try:
            problems = differences(queries[name](spark, sf_dir), con, sql[name])
        except Exception as error:  # noqa: BLE001
            problems = ["".join(traceback.format_exception_only(error))[:1500]]
        wrong += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, flush=True)
    print(f"{len(names) - wrong} of {len(names)} equal; without SQL: {sorted(set(queries) - set(sql))}")
    return wrong


if __name__ == "__main__":
    sys.exit(main())
