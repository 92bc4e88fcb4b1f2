"""``python tests/check_oracle.py [folder] [query ...]``: compare queries with their SQL."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from brambling.session import local_session  # noqa: E402
from tests.compare import differences, oracle_connection  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    connection = oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        begin = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = differences(df, connection, oracles[name])
            else:
                problem = "" if df.collect() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - begin:.1f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
