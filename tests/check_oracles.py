"""Run registered queries against their SQL: ``python tests/check_oracles.py [sf] [query …]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tests.compare import compare, duck  # noqa: E402
from tests.session import session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, sqls = session(), duck(sf_dir), entry.oracle_sql()
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        if name not in sqls:
            continue
        start = time.time()
        try:
            problems = compare(fn(spark, sf_dir), con, sqls[name])
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{name:32s} {time.time() - start:6.1f}s", "ok" if not problems else problems, flush=True)
    print(sorted(set(sqls) ^ set(entry.queries())))
