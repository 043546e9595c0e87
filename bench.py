"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list). Each query is executed in full with the
``noop`` sink (nothing is collected to the driver); the metric is the sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexiflow.plans import catalog  # noqa: E402
from lexiflow.session import build_session  # noqa: E402

HEADLINE = [
    "a7_eval_by_pos",        # flagship: scan, explode, aggregate, join, rollup
    "a3_copy_baseline",
    "a5_mfl_eval",
    "a6_eval_pred",
    "a8_rouge",
    "a15_error_report",
    "s3_tei_tokens",
    "a1_word_stats",
    "a2_line_stats",
    "t1_normalise",
    "s14_to_parallel",
    "a12_change_profile",
    "w3_split_exact",
    "m2_align_med",
    "m3_align_corpus",
    "m6_vote",
    "s12_s1_conllu_roundtrip",
    "m7_template_lemmatiser",
    "a17_lexicon_coverage",
    "w4_nested_samples",
    "j8_check_nbest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="lexiflow-bench")
    # the test tables are files of one row group: deal their rows to the cores
    spark.conf.set("lexiflow.scan.partitions", str(cpus))
    # steady-state timing: warm the JVM (JIT of the tokenising path) and the file
    # cache once, untimed, with the shared token view
    from lexiflow.plans import views
    views.tok(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "sum_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
