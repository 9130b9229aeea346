"""Bench: build the named tables, then time every headline query.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line. Each query is forced with the no-op sink, so the
full plan runs without collecting rows. Table builds are timed separately
(they are written once to the checkpoint folder, as the batch job would save
them); the model fits are timed as their first metrics query. One small untimed
query warms the JVM first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emporia.plans import registry  # noqa: E402
from emporia.plans.session import local_session  # noqa: E402
from emporia.plans.tables import from_testdata  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WITH_MODELS = os.environ.get("BENCH_MODELS", "1") == "1"

BUILDS = ["master_featured", "rfm_olist", "retail_featured"]
QUERIES = [n for n in registry.queries() if re.match(r"^(q\d\d|r\d)_", n)] + [
    "rfm_orders_as_coded", "rfm_capped_exact", "null_profile", "clean_report", "dedup_items", "latest_review",
    "master_featured"]
MODEL_QUERIES = ["lr_metrics", "rf_metrics", "dt_metrics", "gbt_metrics", "kmeans_sweep"]


def sf_of(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main():
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS * 2), app="emporia-bench")
    qs = registry.queries()
    # Untimed warm-up: JVM start, class loading and first code generation.
    spark.read.parquet(f"{SF_DIR}/orders.parquet").groupBy("o_orderstatus").count().collect()
    t = from_testdata(spark, SF_DIR)
    times = {}
    for name in BUILDS:
        t0 = time.time()
        df = getattr(t, name)
        df.write.format("noop").mode("overwrite").save()
        times[f"build_{name}"] = round(time.time() - t0, 3)
    names = QUERIES + (MODEL_QUERIES if WITH_MODELS else [])
    for name in names:
        t0 = time.time()
        qs[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf_of(SF_DIR), "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
