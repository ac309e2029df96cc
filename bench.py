"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import statistics
import sys
import time

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g --conf spark.ui.showConsoleProgress=false pyspark-shell")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# queries whose work grows fastest with the tables; timed once more on the smaller tables, so that growth shows
GROWING = [
    "j05_workspace_mapping", "s02_top3_workspaces", "j06_directory_matching", "j12_evidence_retrieval", "s03_best_entry_per_box",
    "s05_nearest_chunks", "j13_overlap_partners", "j15_box_tracks", "w14_near_duplicates", "w18_group_split", "s07_stable_order",
    "j20_ambiguous_names",
]
GROWTH_SECONDS = 300  # queries not begun by then are named in the result
HEADLINE = [
    "a01_inspection_verdicts", "a02_conflict_resolution", "flt03_observation_validation", "flt16_alarm_gate",
    "j04_custom_rule_merge", "j01_device_names", "w04_running_vote", "a06_majority_vote", "w02_equal_count_bins",
    "a14_scale_buckets", "w10_device_budget", "j16_best_near_anchor", "w13_suppress_by_score", "j14_template_votes",
    "w19_shuffled_group_split", "src08_label_files", "w15_document_chunks", "j17_retrieval",
]


def main() -> None:
    from pilotlamp.plans import load_all
    from pilotlamp.plans.registry import QUERIES, Tables
    from pilotlamp.session import build_session, drop_tables

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    load_all()
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    def timed(name: str, path: str, count: int) -> float:
        """Median of ``count`` runs after one that warms up; without any, the time of that one."""
        times = []
        for _ in range(count + 1):
            start = time.time()
            QUERIES[name].build(Tables(spark, path)).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
            drop_tables(spark)
        print(os.path.basename(path), name, took := round(statistics.median(times[1:] or times), 3), file=sys.stderr, flush=True)
        return took

    took = {name: timed(name, folder, runs) for name in names}
    growth, begun, smaller = {}, time.time(), os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.01")
    for name in GROWING if names is HEADLINE and os.path.isdir(smaller) else []:
        if time.time() - begun < GROWTH_SECONDS:
            growth[name] = [timed(name, smaller, 0), timed(name, folder, 0)]
    print(json.dumps({"metric": "headline queries, warm, median", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": os.path.basename(folder.rstrip("/")), "growth_sf0.01_and_sf": growth,
                      "growth_not_measured": [n for n in GROWING if n not in growth]}))
    spark.stop()


if __name__ == "__main__":
    main()
