"""Run every registered query against its DuckDB oracle: python tests/run_oracles.py [sf_dir] [key...]"""
from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from oracle_compare import compare, duck_connection  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from closequarters.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(E.queries())
    spark = local_session(8)
    con = duck_connection(sf)
    oracles = E.oracle_sql()
    bad = 0
    for k in keys:
        t = time.time()
        try:
            df = E.queries()[k](spark, sf)
            if k in oracles:
                problems, n = compare(df, con, oracles[k])
            else:
                problems, n = [], df.count()
        except Exception as ex:  # report and go on
            problems, n = [f"{type(ex).__name__}: {str(ex)[:400]}"], -1
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {k:24s} rows={n:7d} {time.time() - t:6.2f}s {'(rows only)' if k not in oracles else ''} {'; '.join(problems)}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
