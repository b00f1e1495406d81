"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Each query is run three times and its median counted;
results are written to the ``noop`` sink, so all rows are computed and none is
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark import plans
from tidemark.session import local_session

HEADLINE = [
    "latest_row_number", "latest_dense_rank", "as_of_event_time", "recent_n", "pit_join", "pit_multi_group",
    "builder_pit_n_recent", "star_join", "latest_star_join", "latest_featureset", "prepare_orders",
    "prepare_customers", "ordinal_freq", "minmax_scale", "profile_numeric", "profile_entropy", "profile_topk",
    "hard_delete_anti", "online_upsert", "materialize_online", "failed_records", "split_70_20_10", "compact_preserves",
    "compact_partitions",
]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "tidemark-bench")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the JVM up
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
