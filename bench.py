"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8); names given on
the command line, or "all", replace the headline list.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from quillframe.queries import REGISTRY, Tables
from quillframe.session import local_session

# At least one query per operator family, on the largest tables it applies to.
HEADLINE = [
    "example_report",
    "csv_round_trip",
    "attach_corpus",
    "filter_by_mask",
    "assign_columns",
    "aligned_sum_with_fill",
    "row_numbers",
    "reindex_carried_forward",
    "merge_inner",
    "merge_outer",
    "join_several_tables",
    "interval_lookup",
    "combine_first_tables",
    "grouped_statistics",
    "describe_numbers_by_group",
    "standardise_within_group",
    "histogram_of_numbers",
    "entropy_of_revenue",
    "pivot_table_with_margins",
    "codes_by_first_appearance",
    "flag_duplicates",
    "drop_duplicate_texts",
    "sample_with_replacement",
    "fill_forward",
    "interpolate_by_time",
    "convert_to_narrowest_types",
    "extract_all_matches",
    "repair_report",
    "build_model_input",
    "codes_of_sorted_labels",
    "resample_by_user",
    "rolling_rows",
    "rolling_two_days",
    "rolling_hours_whole_table",
    "rolling_200_rows_by_group",
    "rolling_day_quantiles_whole_table",
    "resample_seven_hours",
    "interval_lookup_with_open_ends",
    "expanding_statistics",
    "folds_by_group",
    "batch_plan",
    "balanced_cross_entropy",
    "masked_mean_pooling",
    "linear_classifier",
    "boosted_tree_classifier",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    names = sys.argv[1:] or HEADLINE
    names = list(REGISTRY) if names == ["all"] else names
    tables = Tables(spark, folder)
    REGISTRY["merge_outer"].run(tables).write.format("noop").mode("overwrite").save()  # start-up, not timed
    REGISTRY["row_numbers"].run(tables).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        began = time.perf_counter()
        REGISTRY[name].run(tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1].rstrip(".")) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
