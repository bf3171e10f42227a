"""Times the headline queries; prints one JSON line.

Warm median of three runs per query, results written to Spark's noop sink. ``BENCH_SF_DIR`` and
``BENCH_CPUS`` choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hailstat.operators import completion, hotareas, trips  # noqa: E402
from hailstat.plans import catalog, reports  # noqa: E402
from hailstat.session import build_session  # noqa: E402
from hailstat.sources import sample  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = (
    "p_rate_year p_rate_summary d_rate_summary d_reg_summary t_city_board t_platform_summary t_order_rider_pay "
    "r_new_active r_retention_summary r_active_summary h_cell h_hot_day h_hot_delta h_hot_order h_heat_since "
    "v_station v_district_join key_salted src_gps_line src_cdc_json c_cdc_apply g_point_store g_order_span "
    "g_live_orders g_hour_count g_track_push g_stream c_cdc_stream fn_html_filter m_task_metrics m_health_ratios"
).split()

# The forms with joins or windows that the one-pass forms stand in for; not part of the total.
OTHER_FORMS = {
    "p_rate_summary_by_joins": lambda s, d: completion.completion_summary_by_joins(
        sample.trips(s, d, *catalog.CITY_INPUT), completion.CITY, catalog.TRIP_PERIOD, F.lit("1")
    ),
    "d_rate_summary_by_joins": lambda s, d: completion.completion_summary_by_joins(
        sample.trips(s, d, *catalog.DRIVER_INPUT), completion.DRIVER, catalog.TRIP_PERIOD, F.col("driver_id")
    ),
    "t_city_board_by_joins": lambda s, d: trips.merge_board(
        trips.vehicle_counts(sample.trips(s, d, *catalog.VEHICLE_INPUT), catalog.TRIP_PERIOD),
        trips.trip_counts(sample.trips(s, d, *catalog.AREA_INPUT), catalog.TRIP_PERIOD),
    ),
    "h_hot_day_by_window": lambda s, d: hotareas.hot_cells_by_window(
        sample.trips(s, d, *reports.HOT_COLUMNS), *catalog.HOT_NOW
    ),
    "h_hot_delta_by_join": catalog.QUERIES["h_hot_delta_stored"],
}


def timed(spark, build) -> float:
    taken = []
    for _ in range(RUNS + 1):
        started = time.perf_counter()
        build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - started)
    return round(statistics.median(taken[1:]), 3)


def main() -> None:
    spark = build_session("hailstat-bench", f"local[{CPUS}]")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(spark, catalog.QUERIES[name]) for name in HEADLINE}
    forms = {name: timed(spark, build) for name, build in OTHER_FORMS.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "other_forms": forms,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
