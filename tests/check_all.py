"""Run registered queries against their SQL: python -m tests.check_all [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    import __spark_entry__ as entry
    from smelter.session import build_session
    from tests.oracle import connect, differences

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                found, rows = differences(df, con, oracle[name]), ""
            else:
                found, rows = [], f"rows only: {len(df.collect())}"
        except Exception as e:
            found, rows = [f"{type(e).__name__}: {str(e)[:900]}"], ""
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:28s} {time.time() - start:6.2f}s {rows}", flush=True)
        for line in found:
            print("      ", line, flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
