"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (sample folder) and BENCH_CPUS (cores) choose the run.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from headway.catalog import all_queries
from headway.session import local_session

HEADLINES = [
    "q2_bus_occupancy",
    "q3_feature_table",
    "j7_weather_asof",
    "q6_suggested_buses",
    "q7_route_maps",
    "q8_passenger_flow",
    "a11_traffic_heatmap",
    "a13_traffic_alerts",
    "m8_forecast_grid",
    "d1_first_predictions",
    "q10_tickets",
    "q10_sensors",
    "j16_dated_departures",
    "q11_gps_track",
    "k2_inserted_if_absent",
    "k3_upserted_documents",
    "w7_champion_runs",
    "w8_sampled_moments",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    seconds = {}
    # One untimed query, so that the first timed one does not pay for starting up.
    _run(registered["a1_boarding_counts"](spark, folder))
    for name in HEADLINES:
        begin = time.perf_counter()
        _run(registered[name](spark, folder))
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(folder).name.removeprefix("sf")),
                "cpus": cores,
            }
        )
    )


def _run(df) -> None:
    """Compute every column of every row, and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


if __name__ == "__main__":
    main()
