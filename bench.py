"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores; BENCH_QUERIES, a comma
list, other queries of the registry."""

from __future__ import annotations

import json
import os
import tempfile
import time

from shelfstream import queries as registry
from shelfstream.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "item_rating_counts", "popular_items", "join_ratings_users", "join_mixed_keys", "word_count",
    "topn_per_user", "encode_ids", "assign_ids", "tumbling_count", "parse_nested",
    "publish_messages", "batch_metrics", "stream_load_users", "stream_load_ratings",
    "word_count_stream", "als_rmse",
)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfstream-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registry.queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    # start the executor threads and the Parquet reader before anything is timed
    known["item_rating_counts"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        known[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
