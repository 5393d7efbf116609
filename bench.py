"""Times the headline queries; prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortloom.plans import catalog  # noqa: E402
from cohortloom.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_trait_residuals", "W1_latest_valid", "S2_semi_scan", "S10_batch_wide", "P1_norm_question", "P3_content_tokens", "J6_same_time_pair",
    "J7_prompt_crosswalk", "A2_person_median", "A4_trial_rates", "A7_distribution", "A13_pair_agreement", "A23_variant_frequency", "W3_average_rank",
    "B1_one_vs_rest", "B10_gated_floor", "B13_composite_scales", "B23_approved_composite", "T1_rank_normal", "T2_residualize", "T8_correlation_grid",
    "G2_component_table", "G3_unrelated_set", "G4_kinship", "V1_variant_ladder", "V6_ld_prune", "V8_projection", "V10_association", "M1_feature_matrix",
    "M5_cross_fitted_scores", "M11_fold_safe_calibration",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "4"), "bench", memory=os.environ.get("BENCH_MEMORY", "5g"))
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and of the Python workers is not part of any query.
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    spark.range(8).mapInPandas(lambda it: it, "id long").count()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
