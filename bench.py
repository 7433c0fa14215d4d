"""Time headline queries on one folder; prints one JSON line.

Each query is built and run twice into a sink that discards its rows. The figure of a query is the
second run: the first one pays for code generation and class loading, which a long job does not feel.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from govmill import registry  # noqa: E402

HEADLINE = (
    "gold_residency gold_asset_counts fullname_classification base_products score_residency score_tag score_cc "
    "score_defender compliance_summary residency_eligibility cc_investigation_queue compute_inventory "
    "assessment_rollup alert_rollup resource_rollup catalog_deltas asset_count_deltas residency_deltas kpi_timeline "
    "drift_alerts anomaly_points residency_change_plan enforce_tag_policy policy_state_by_control sum_nested_counts "
    "redact_text redaction_report leak_scan reference_lineage"
).split()


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("govmill-bench")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck_seconds(sf_dir: str, keys: list[str]) -> dict[str, float]:
    """The SQL twins on one machine, for comparison."""
    import duckdb

    from govmill.oracles import load_oracles
    from govmill.sources.fixtures import DRIVER_TABLES

    con, sql, out = duckdb.connect(), load_oracles(), {}
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for k in keys:
        t0 = time.perf_counter()
        con.execute(sql[k]).fetchall()
        out[k] = round(time.perf_counter() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark, cold, warm = session(), {}, {}
    for key in HEADLINE:
        for times in (cold, warm):
            t0 = time.perf_counter()
            registry.run(key, spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - t0, 3)
    spark.stop()
    line = {"metric": "headline_queries_warm_total", "value": round(sum(warm.values()), 3), "unit": "sec",
            "queries": warm, "cold": cold, "sf": Path(sf_dir).name.removeprefix("sf")}
    if "--duckdb" in sys.argv:
        line["duckdb"] = duck_seconds(sf_dir, list(HEADLINE))
    print(json.dumps(line))


if __name__ == "__main__":
    main()
