"""Time the headline queries: one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from foroscope.plans import QUERIES  # noqa: E402
from foroscope.session import build_session  # noqa: E402

HEADLINE = """copart_edges copart_strong degree_centrality components clustering_coeff tfidf_top_terms burrows_delta
style_features actor_style cosine_pairs item_cohesion utc_offset monthly_activity activity_spikes even_time_sample
topn_longest describe_group funnel net_reputation snapshot_transitions handle_fuzzy clean_posts strip_markup
quality_report ingest_sql_rows betweenness_pivots""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["monthly_activity"](spark, sf_dir).count()  # start the JVM's code paths
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
