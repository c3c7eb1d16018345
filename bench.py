"""Times the headline queries and prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

from cratelight.plans.registry import load
from cratelight.session import local_session

HEADLINE = [
    "scenario_winebar", "scenario_club", "scenario_opening", "scenario_club_disco", "song_filter", "song_card", "mood_wide",
    "pooled_scores", "topk_mean_pool", "class_mean_top", "describe", "price_quantiles", "histogram", "top_songs",
    "top_n_per_song", "timeline", "patches", "tag_repair", "nfkc_join", "dedupe_ingest", "stream_ingest", "ingest_documents", "xml_collection",
    "document_tags", "nfkc_text", "tag_collapse", "playlist_labels", "vector_mean_by_label", "knn_cosine", "knn_euclid",
    "compare_songs", "candidate_edges", "next_song", "setlist", "score_head", "score_model", "ann_knn", "pca2", "kmeans",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()  # start-up is not part of any query
    registered, seconds = load(), {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        registered[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
