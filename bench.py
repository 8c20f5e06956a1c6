"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the number of local cores. Every result is
computed in full and written to Spark's noop sink.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textloom.plans.queries import QUERIES  # noqa: E402
from textloom.session import local_session  # noqa: E402

HEADLINE = """null_profile category_filter category_counts category_members exact_sample row_index
tokenize_texts lemma_lookup vocabulary term_counts tfidf tfidf_holdout top_words_count
top_words_tfidf document_mean_vector mean_vector class_report model_comparison encode_sequence
batch_assign nmf_one_step nmf_topics lda_topics svc_tfidf logreg_scores stream_score""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        started = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
