"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    runs per query, the best counts (default 1)
Names given as arguments replace the headline queries; ``all`` runs every registered one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.registry import QUERIES  # noqa: E402
from tablewright.session import build_session  # noqa: E402

# one query per operator, and the whole table sets; left out are variants of these and single tables of the sets
HEADLINE = [
    "src_json_schema", "src_csv_headed", "src_csv_delim", "src_parquet_glob", "src_path_template", "stage_mapped",
    "sink_parquet", "sink_parquet_partitioned", "sink_csv_quoted", "sink_clustered", "sink_bucketed",
    "load_append", "load_overwrite", "ddl_roundtrip",
    "filter_page_user", "filter_blank", "project_rename", "cast_text", "ts_epoch_ms", "parse_dates", "split_pair",
    "dec_scale0", "key_md5", "key_sequence", "key_monotonic",
    "dim_distinct_row", "dim_first_wins", "dim_upsert_column", "table_upsert_last_wins", "table_upsert_merge",
    "calendar_rows", "calendar_distinct", "calendar_wh", "calendar_two_dates", "rollup_group",
    "fact_inner_natural", "fact_inner_salted", "fact_left_natural", "fact_join_time", "fact_lookup_one",
    "join_dim_dim", "enrich_ports", "enrich_states",
    "lookup_by_key", "lookup_partition_sorted", "lookup_inverted",
    "dq_non_empty", "dq_unique_rows", "dq_unique_keyed", "dq_null_keys", "dq_expected", "dq_key_unique", "dq_report",
    "star_rowwise_built", "star_warehouse_built", "star_lake_built", "star_scheduled_built", "lake_built",
    "lookups_built", "stream_incremental",
]


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds until every row of the result has been computed."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **settings)
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed query, so that the first timed one does not pay for starting up
    run(spark, "rollup_group", sf_dir)
    seconds = {}
    names = sys.argv[1:] or HEADLINE
    for name in QUERIES if names == ["all"] else names:
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
