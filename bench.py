"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3), BENCH_QUERIES (names).
Each query is written to Spark's no-op sink, so all its rows are computed; the median of the runs counts.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from gleaner.plans.queries import QUERIES

HEADLINE = ["word_count", "important_words", "bigram_count", "cooccurrence", "pos_tfidf", "feature_counts", "auto_label",
            "entity_count", "slot_range", "slot_date_consensus", "slot_report", "rebuild_records", "doc_summary", "rouge_2",
            "rouge_best_pair", "chi2_features", "kmeans_clusters", "mlp_predict"]


def session(cpus):
    return (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
            .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(os.path.basename(sf)[2:]), "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
