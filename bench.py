"""Time headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and threads; names as arguments run
other queries than the headline ones ("all" runs every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "a3_session_catalog",
    "a8_select_work",
    "b3_qualified_sessions",
    "c3_pair_ranked",
    "c5_skip_attribution",
    "c9_segment_containment",
    "d2_gap_fill",
    "d8_windows_on_slots",
    "d16_sliding_windows",
    "d18_epochs",
    "e3_welch_psd",
    "e4_line_noise",
    "e1_bandpass",
    "f4_reject_segments",
    "f8_bad_sample_mask",
    "f11_channel_correlation",
    "g6_feasible_channels",
    "g10_describe_moment_wavelength",
    "g11_module_pairs",
    "g14_value_stats",
    "g23_best_axis_convention",
    "h2_tokens",
    "h6_token_word_times",
    "h9_correctness_score",
    "i4_window_stats",
    "j8_window_labels",
    "j12_eye_good",
    "j14_neuro_lang",
    "j16_eye_good_label_counts",
    "k6_row_split",
    "k8_split_by_size",
    "l3_gap_stats",
    "l8_column_profile",
]


def main(argv: list[str]) -> None:
    from sessionloom.plans.catalogue import QUERIES
    from sessionloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = list(QUERIES) if argv == ["all"] else argv or HEADLINE
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "6g"), int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["l8_column_profile"](spark, sf_dir).collect()  # start the engine
    took: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
