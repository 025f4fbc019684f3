"""Run registered queries and print row counts and seconds (no oracle)."""
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from __spark_entry__ import queries  # noqa: E402
from loomkit.session import get_spark  # noqa: E402

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]", shuffle_partitions=8)
    q = queries()
    for n in sys.argv[1:] or sorted(q):
        t = time.time()
        try:
            rows = q[n](spark, sf).collect()
            print(n, len(rows), round(time.time() - t, 2), rows[:2], flush=True)
        except Exception as e:
            print(n, "ERROR", repr(e)[:800], flush=True)
