"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans.catalog import QUERIES  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.staging import release  # noqa: E402

HEADLINE = [
    "filter_daterange", "drop_expired", "class_floor", "sample_n", "scope_map",
    "cleaning_sections", "cleaning_funnel", "out_of_scope_verdicts", "keyed_merge",
    "inference_job", "result_distribution", "process_count_apply", "minmax_apply",
    "category_vocab", "onehot_long", "clean_text", "stem_dictionary", "tfidf_long",
    "tfidf_stemmed", "stratified_split", "stratified_folds", "special_report",
    "report_by_verdict", "evaluation_job", "csv_scan", "prepared_features", "encoded_code",
    "dense_text", "rf_correctness",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["class_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "unit": "sec",
        "value": round(sum(seconds.values()), 3), "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
