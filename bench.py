"""Headline timings, one JSON line: the stages from the given tables to the published set, then
single queries over the staged tables. Every stage reads what the stage before it wrote."""
from __future__ import annotations

import json
import os
import sys
import time
import uuid
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from marginwatch.plans.registry import QUERIES  # noqa: E402
from marginwatch.plans.retail import Workspace  # noqa: E402
from marginwatch.sources import tables as T  # noqa: E402
from marginwatch.streaming import landing  # noqa: E402

SINGLE = ["c27_dominant_product_attributes", "c29_first_valid_copy", "c34_rule_counts", "d05_dim_product", "d08_fact_purchases",
          "e05_branch_base", "e06_product_base", "e07_supplier_base", "e09_branch_monthly", "e12_inventory_base", "f04_peer_anomalies",
          "f06_temporal_anomalies", "g01_percentile_rank_distributed", "g03_branch_scores", "g06_product_flags", "g08_stockout_scores",
          "h02_revenue_leakage", "i04_sales_detail", "i19_other_branches_median"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("marginwatch-bench")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    w = Workspace.of(spark, sf_dir)
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.time()
        work()
        times[name] = round(time.time() - start, 3)

    def ingest() -> None:
        base = f"{w.root}/bench-{uuid.uuid4().hex}"
        stream = landing.message_stream(spark, {"format": "parquet", "path": f"{w.root}/messages"})
        landing.land(stream, f"{base}/raw", f"{base}/checkpoint").awaitTermination()

    # The mapping of the tables to events is ours alone; the stages that follow are the compared ones.
    timed("map_tables_to_events", lambda: (w.source(), w.events()))
    timed("stage_encode_messages", w.messages)
    timed("stage_ingest", ingest)
    timed("stage_clean", lambda: (w.judged(), w.account()))
    timed("stage_transform", lambda: (w.dims(), w.facts()))
    timed("stage_features", w.features)
    timed("stage_analytics", lambda: (w.anomalies(), w.scorecards(), w.leakage(), w.kpis()))
    timed("stage_publish", lambda: T.publish(spark, w.published(), f"{w.root}/published", uuid.uuid4().hex, datetime.now()))
    total = sum(v for k, v in times.items() if k.startswith("stage_"))
    for name in SINGLE:
        timed(name, lambda: QUERIES[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "all_stages_wall_clock", "value": round(total, 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
