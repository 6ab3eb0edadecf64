"""Times the whole batch, from delivered CSV extracts to the checked call queue.

The extracts are written from the parquet tables first, outside the clock.
BENCH_SF_DIR, BENCH_CPUS and BENCH_MEMORY as in bench.py; BENCH_ITERATIONS sets
the boosting rounds (default 300, the library's).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from salesloom.context import session
from salesloom.plans import pipeline, propensity
from salesloom.sources import testdata


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    iterations = int(os.environ.get("BENCH_ITERATIONS", propensity.ITERATIONS))
    scratch = tempfile.mkdtemp(prefix="salesloom-batch-")
    spark = session("bench-batch", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    testdata.deliver(testdata.context(spark, sf_dir), f"{scratch}/delivery")
    begin = time.perf_counter()
    ctx = pipeline.run(
        spark, f"{scratch}/delivery", "batch", f"{scratch}/models", testdata.AS_OF,
        testdata.TRAIN_AS_OF, fact_rows=(1, float("inf")), iterations=iterations, gates=False,
    )
    seconds = time.perf_counter() - begin
    print(json.dumps({
        "metric": "batch_seconds", "value": round(seconds, 1), "unit": "sec",
        "fact_rows": ctx["fact"].count(), "iterations": iterations,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
