"""Compare every registered query with its SQL: ``python -m tests.check_all SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

import __spark_entry__ as contract
from stridecast.session import build_session
from tests.compare import connect, differences


def main(sf_dir: str, *names: str) -> int:
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, sql = contract.queries(), contract.oracle_sql()
    con, failed = connect(sf_dir), []
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            wrong = differences(df, con, sql[name]) if name in sql else None
            note = "" if name in sql else f" rows={df.count()}"
        except Exception as error:  # report every query, not only the first bad one
            wrong, note = f"{type(error).__name__}: {str(error)[:600]}", ""
            if "-v" in sys.argv:
                traceback.print_exc()
        if wrong:
            failed.append(name)
        print(f"{'BAD ' if wrong else 'ok  '}{name} {time.time() - started:.1f}s{note} {wrong or ''}", flush=True)
    print(f"{len(failed)} failed of {len(names or queries)}: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(*[a for a in sys.argv[1:] if a != "-v"]))
