"""Print the executed physical plan of registered queries (after running
them, so AQE's final plan is shown).

    python tools/plan.py [sf_dir] key [key ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mktlens.plans.registry import QUERIES  # noqa: E402
from mktlens.session import local_session  # noqa: E402

args = sys.argv[1:]
sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
keys = [a for a in args if not os.path.isdir(a)]
spark = local_session(8, shuffle_partitions=16)
for k in keys:
    df = QUERIES[k](spark, sf)
    t0 = time.time()
    df.write.format("noop").mode("overwrite").save()
    print(f"== {k}: {time.time() - t0:.2f}s")
    df.explain("formatted") if os.environ.get("FULL") else print(df._jdf.queryExecution().executedPlan().toString())
