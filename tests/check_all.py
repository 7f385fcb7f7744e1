"""Compare every query with its SQL: ``python tests/check_all.py [folder] [name ...]``."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import connect, duck_rows, spark_rows  # noqa: E402

from salesloom import scratch  # noqa: E402
from salesloom.plans.catalogue import QUERIES  # noqa: E402
from salesloom.plans.oracle import ORACLE  # noqa: E402
from salesloom.session import build_session  # noqa: E402


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", 8, spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(base)
    bad = 0
    for name in names:
        try:
            begin = time.time()
            got = spark_rows(QUERIES[name](spark, base))
            middle = time.time()
            if name not in ORACLE:
                print(f"rows-only {name} {len(got[2])} rows {middle - begin:.2f}s", flush=True)
                continue
            want = duck_rows(db, ORACLE[name])
            problems = [
                what
                for what, a, b in zip(("names", "types", "rows"), got, want)
                if a != b
            ]
            if problems:
                bad += 1
                differ = [p for p in zip(got[2], want[2]) if p[0] != p[1]][:2]
                print("DIFF", name, problems, len(got[2]), len(want[2]))
                print("   ", got[:2], want[:2], *differ, sep="\n    ")
            else:
                print(
                    f"ok {name} {len(got[2])} rows {middle - begin:.2f}s "
                    f"sql {time.time() - middle:.2f}s",
                    flush=True,
                )
        except Exception:
            bad += 1
            print("ERROR", name)
            traceback.print_exc(limit=3)
    scratch.clear(spark)
    print("failures:", bad)


if __name__ == "__main__":
    main()
