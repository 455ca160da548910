"""Run named queries, write each result as CSV and one JSON report about all of them."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, functions as F

from plateflow.model import Marketplace
from plateflow.plans.registry import QUERIES

# The standard report and the queries behind its names.
REPORT = {
    "platform_kpis": "ru1_platform_kpis", "peak_hours": "ru2_peak_cells", "top_restaurants": "ru3_top_restaurants",
    "rfm_segments": "ru4_rfm_segments", "delivery_performance": "ru5_delivery_profiles",
    "churn_segments": "ru6_churn_segments",
}


def write_csv(df: DataFrame, path: str) -> int:
    """Write ``df`` with a header and return its row count, from the same job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    return seen.get["rows"]


def run_report(m: Marketplace, as_of: date, out: str, names: Iterable[str] | None = None) -> dict:
    """Results under ``out``/<name>, the report under ``out``/analytics_report. A failing query does not stop the rest."""
    report: dict = {"generated_at": datetime.now(timezone.utc).isoformat(), "results": {}}
    for name in names or REPORT:
        query = QUERIES.get(REPORT.get(name, name))
        if query is None:
            report["results"][name] = {"error": "unknown query"}
            continue
        start = time.time()
        try:
            rows = write_csv(query(m, as_of), f"{out}/{name}")
            report["results"][name] = {
                "rows": rows, "duration_ms": round((time.time() - start) * 1000, 1), "output": f"{out}/{name}"}
        except Exception as error:  # each query stands alone
            report["results"][name] = {"error": str(error)}
    text = m.spark.range(1).select(F.lit(json.dumps(report, indent=2)).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(f"{out}/analytics_report")
    return report
