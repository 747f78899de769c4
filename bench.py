"""Time the headline queries and print one JSON line.

Every query runs once to warm up and once timed, over whole tables, into a sink that
reads every row.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plotloom.growth.grid import grid_search
from plotloom.queries import QUERIES
from plotloom.queries.base import daily_growth
from plotloom.session import build_session

HEADLINES = [
    "trait_load",
    "load_compounddata",
    "lookup_first_match",
    "lookup_any_of",
    "lookup_salted",
    "append_if_absent_three_keys",
    "denormalise",
    "compound_view",
    "assign_ids",
    "to_long",
    "mean_strict",
    "fit_stats",
    "best_by",
    "histogram",
    "replace_first",
    "sample_attributes",
    "refresh_entities",
    "load_plots",
    "fit_linear_by_user",
    "fit_logistic",
    "fit_gompertz",
    "param_interval",
    "contrast_interval",
    "rate_table",
    "local_smooth",
    "trait_series",
]

# The published coarse grid, one million parameter points, over daily series of five groups.
COARSE_AXES = {"M0": (0.0, 1.0, 100), "r": (0.0, 0.2, 100), "beta": (0.0, 0.99, 100)}


def grid_million(spark, folder):
    return grid_search(daily_growth(spark, folder), ["g"], COARSE_AXES)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", partitions=cpus, memory="12g")
    wanted = {name: QUERIES[name] for name in HEADLINES}
    wanted["grid_search_million_points"] = grid_million
    times: dict[str, float] = {}
    for name, query in wanted.items():
        if name != "grid_search_million_points":
            run(query(spark, folder))
        begin = time.perf_counter()
        run(query(spark, folder))
        times[name] = round(time.perf_counter() - begin, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    line = {
        "metric": "headline queries, total wall clock",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
