"""Time the headline queries, medians of BENCH_RUNS runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tastegraph.operators import factors, item_cf, samples, walks
from tastegraph.plans import tables
from tastegraph.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
#: A smaller folder, run once, for the growth of each job.
SMALL = os.environ.get("BENCH_SMALL_DIR", "/root/testdata/sf0.01")


def jobs(spark, folder):
    rated = tables.ratings(spark, folder)
    films = tables.movies(spark, folder)
    yield "fer_samples", lambda: samples.rating_samples(rated, films)
    yield "movie_rolling_features", lambda: samples.movie_rolling_features(samples.add_label(rated))
    yield "item_cf", lambda: item_cf.item_cf(rated)
    yield "random_walks", lambda: walks.random_walks(rated)
    yield "metapath_walks", lambda: walks.rating_metapath_walks(rated, films)
    yield "als_fit", lambda: factors.als_factors(factors.als_fit(rated))


def timed(spark, folder: str, times: int) -> tuple[dict[str, float], dict[str, float]]:
    """Median seconds of each job and those of its first, cold run; the ratings are derived once, before."""
    start = time.time()
    tables.ratings(spark, folder)
    medians = {"derive_ratings": round(time.time() - start, 3)}
    firsts = dict(medians)
    for name, make in jobs(spark, folder):
        runs = []
        for _ in range(times):
            start = time.time()
            make().write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        firsts[name] = round(runs[0], 3)
        medians[name] = round(sorted(runs)[len(runs) // 2], 3)
    return medians, firsts


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]", max(int(CPUS), 8) if CPUS.isdigit() else 8,
        **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings, firsts = timed(spark, FOLDER, RUNS)
    other = os.path.isdir(SMALL) and os.path.realpath(SMALL) != os.path.realpath(FOLDER)
    small = timed(spark, SMALL, 1)[0] if other else {}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "runs": RUNS, "first_runs": firsts, "small": {"folder": os.path.basename(SMALL), "queries": small},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
