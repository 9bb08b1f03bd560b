"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from framesift import catalog  # noqa: E402
from framesift.session import build_session  # noqa: E402

HEADLINE = (
    "quality_gate",
    "quality_fold",
    "frame_verdict",
    "class_split_rollup",
    "mask_area_bbox",
    "mask_overlap",
    "mask_fragments",
    "mask_erode",
    "depth_residual",
    "instance_xyz",
    "scene_cuts",
    "segments",
    "capture_groups",
    "group_summary",
    "label_rules",
    "dup_across_splits",
    "leakage",
    "rerun_ranges",
    "merge_ranges",
    "scene_integrity",
    "scene_state",
    "detection_routing",
    "best_epoch",
    "throttle",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "framesift-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    spark.range(1000).groupBy().count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = pathlib.Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale)}))


if __name__ == "__main__":
    main()
