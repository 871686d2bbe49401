"""Runs registered queries against their SQL: python tests/check.py [folder] [name part ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import connect, difference  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"}
settings.update(pair.split("=", 1) for pair in os.environ.get("CHECK_SETTINGS", "").split(";") if pair)
spark = build_session("check", "local[8]", **settings)
spark.sparkContext.setLogLevel("ERROR")
connection, sqls, bad = connect(root), oracle_sql(), 0
for name, run in queries().items():
    if parts and not any(part in name for part in parts):
        continue
    start = time.perf_counter()
    try:
        if name in sqls:
            problem = difference(run(spark, root), connection, sqls[name])
        else:
            problem = None if run(spark, root).count() else "no rows"
    except Exception as error:
        problem = f"{type(error).__name__}: {str(error)[:1500]}"
    bad += problem is not None
    print(f"{'ok  ' if problem is None else 'FAIL'} {time.perf_counter() - start:6.2f}s {name}"
          f"{'' if name in sqls else ' (rows only)'}{'' if problem is None else ': ' + problem}", flush=True)
print(f"{bad} failures")
