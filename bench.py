"""Time the headline steps and queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local threads. The layers are built
first and timed step by step, so no query hides the cost of the tables it reads.
"""

from __future__ import annotations

import json
import os
import time

from floodledger.operators.dedup import latest_per_key
from floodledger.plans import profile, quality, silver, views
from floodledger.plans.warehouse import build_gold, build_silver, land_csv
from floodledger.schemas import CLAIM_COLUMNS, CLAIM_KEY
from floodledger.session import builder
from harness.registry import QUERIES
from harness import catalog  # noqa: F401
from harness.catalog.reading import csv_folder
from harness.workspace import workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        builder("bench")
        .master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        # the tables are small: several row groups per file, so that more threads take part
        .config("spark.hadoop.parquet.block.size", str(1 << 20))
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # warm up
    ws = workspace(spark, SF_DIR)
    times: dict[str, float] = {}

    def timed(name: str, step, runs: int = RUNS):
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            result = step()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        return result

    landed = {e: csv_folder(ws, e) for e in ("claims", "policies")}
    for e, folder in landed.items():
        timed(f"land_csv_{e}", lambda e=e, folder=folder: land_csv(spark, f"{folder}/*", ws.scratch("landed"), e), runs=1)
    bronze = {e: timed(f"bronze_{e}", lambda e=e: ws.bronze(e), runs=1) for e in ("claims", "policies")}
    layer, _ = timed("build_silver", lambda: build_silver(bronze, ws.scratch("silver"), ws.states))
    star, _ = timed("build_gold", lambda: build_gold(layer, ws.scratch("gold")))

    timed("k01_clean_claims", lambda: noop(silver.clean_claims(bronze["claims"])))
    timed("k02_clean_policies", lambda: noop(silver.clean_policies(bronze["policies"])))
    stamped = bronze["claims"].select(*CLAIM_COLUMNS, "ingestion_timestamp")
    timed("w01_dedup", lambda: noop(latest_per_key(stamped, CLAIM_KEY, ["ingestion_timestamp"])))
    for name, view in views.VIEWS.items():
        timed(name, lambda view=view: noop(view(star)))
    timed("v01_state_grain", lambda: noop(views.loss_ratio(star, "state")))
    timed("k11_profile", lambda: noop(profile.profile_entity(bronze["claims"].select(*CLAIM_COLUMNS), "claims")))
    timed("quality_silver", lambda: noop(quality.silver_suite(bronze, layer)))
    timed("quality_gold", lambda: noop(quality.gold_suite(bronze, layer, star)))
    for name in ("a08_percentiles_by_group", "w01_dedup_lineitem", "o03_top_k_per_group_large_k", "t01_incremental_files"):
        timed(name, lambda name=name: noop(QUERIES[name](spark, SF_DIR)), runs=1 if name.startswith("t") else RUNS)

    print(
        json.dumps(
            {
                "metric": "total_seconds_headline",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
