"""Run registered queries against their SQL: ``python tests/check_queries.py [name part ...]``."""

import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

import __spark_entry__ as entry
from invspark.session import local_session
from tests.compare import differences, oracle

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-")}
    spark, con = local_session(8, **shared), oracle(sf)
    sqls, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.time()
        try:
            df = run(spark, sf)
            problems = differences(df, con, sqls[name]) if name in sqls else ([] if df.count() >= 0 else ["?"])
        except Exception as error:
            problems = [str(error)[:600]]
            if wanted:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - began:.1f}s {'' if name in sqls else '(rows only)'}", flush=True)
        for p in problems:
            print("   ", p, flush=True)
    print("bad:", bad)
