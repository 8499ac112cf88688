"""Benchmark: ingest (star-schema build) plus the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MODELS=1 to include the 200-tree boosted models.  Prints one JSON line.
Each query is forced with the ``noop`` sink (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import queries as Q  # noqa: E402
from tessera.session import local_session, work_dir  # noqa: E402
from tessera.sources import stage as S  # noqa: E402

HEADLINE = [
    "genre_revenue",
    "lifecycle_ordered",
    "platform_comparison",
    "discount_effect",
    "discount_effect_clean",
    "calendar_rollup",
    "revenue_sanity",
    "row_count_check",
    "fd_audit",
    "nonfinite_audit",
    "observation_null_counts",
    "target_distribution",
    "exact_sample",
    "stratified_split",
    "label_encode",
    "class_weights",
    "classification_report",
    "roc_auc",
    "lr_metrics",
]
MODELS = ["gbt_v1_metrics", "gbt_v2_metrics"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="tessera-bench")
    times: dict[str, float] = {}

    # Ingest: derive the flat source and write the star schema into a fresh folder.
    root = f"{work_dir(spark)}/tessera-bench/{uuid.uuid4().hex[:12]}"
    t = time.time()
    st = S.build_stage(spark, sf_dir, root)
    times["ingest_star_schema"] = round(time.time() - t, 3)
    S.adopt(spark, sf_dir, st)

    t = time.time()
    Q.prepared(spark, sf_dir)
    times["prepare_sample_encode_split"] = round(time.time() - t, 3)

    # Schema discovery on the raw-file form of the source (sampled type inference).
    Q.observations_csv(spark, sf_dir)  # write the CSV form first (not timed)
    t = time.time()
    run(Q.QUERIES["describe_csv_source"](spark, sf_dir))
    times["inspect_csv_schema"] = round(time.time() - t, 3)

    names = HEADLINE + (MODELS if os.environ.get("BENCH_MODELS") == "1" else [])
    for name in names:
        t = time.time()
        run(Q.QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t, 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds_ingest_plus_headline_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "rows": st.counts,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
