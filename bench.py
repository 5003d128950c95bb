"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from ecoledger.session import get_session

HEADLINE = (
    "class_index", "typology", "eoo_points", "eoo_by_class", "aoo_cells", "aoo_by_class",
    "criterion_b_assessment", "criteria_table", "raster_area", "raster_overlap",
    "categorical_pixels", "palette_by_group", "sorted_copy", "layout_verdicts", "cache_readiness",
    "rendered_pages", "page_changes", "bundle_usage", "rewritten_pages", "geojson_vertices",
    "legend_mismatches", "orphan_pages",
)
REPEATS = 3


def run(query, spark, sf: str) -> float:
    """Seconds to compute every column of a query's result."""
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "ecoledger-bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    from ecoledger.catalog.queries import all_queries

    registered = all_queries()
    run(registered["class_sizes"], spark, sf)  # start the JVM paths once
    seconds = {}
    for name in HEADLINE:
        # the median of three, so a slow first run does not count
        runs = sorted(run(registered[name], spark, sf) for _ in range(REPEATS))
        seconds[name] = round(runs[REPEATS // 2], 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
