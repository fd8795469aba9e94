"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from visitgrid.catalog import load_catalog  # noqa: E402
from visitgrid.session import build_session  # noqa: E402

HEADLINE = (
    "measurements_by_hospital", "grid_scalar_lookup", "grid_rows_until_blank", "grid_table_pivot", "grid_header_range",
    "grid_many_tables", "grid_label_search", "to_float_locale", "to_date_text", "limit_checks", "filename_ids",
    "resolve_references", "visit_id_assign", "trace_columns", "visit_stats_by_hospital", "scalar_wide", "field_names",
    "union_by_name", "spec_overlay", "name_numbering", "distinct_ratio", "audit_metrics", "report_join", "result_summary",
    "partitioned_visits", "json_archive", "workbook_scan", "workbook_tables", "batch_export_many",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "visitgrid-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = load_catalog()
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("count(*)").collect()  # start the session
    times = {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):  # the first run also compiles
            started = time.perf_counter()
            catalog[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        times[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
