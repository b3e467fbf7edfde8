"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from riskloom.session import build_session

HEADLINE = ["referral_metrics", "traffic_class_v2", "address_bar_hops", "mfa_engagement", "high_traffic", "decision_tree", "ad_chain_reset", "work_lists", "ssl_scores", "url_parts", "semantic_content", "page_features", "rude_rules", "responses_without_repeats"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    from riskloom.plans import page_queries  # noqa: F401  (registers its queries)
    from riskloom.plans.queries import queries

    known, took = queries(), {}
    known["work_lists"](spark, sf).write.format("noop").mode("overwrite").save()  # the session's warm-up
    for name in HEADLINE:
        began = time.perf_counter()
        known[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
