"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from millrace.session import local_session
from verification.queries import QUERIES

HEADLINE = (
    "resolve_inner", "resolve_left", "resolve_hot_keys", "null_sentinel_join", "fk_violations",
    "rejects_all", "rejects_by_rule", "multi_rule_rows", "valid_claims",
    "upsert_dim", "upsert_dim_null_key", "upsert_twice", "upsert_fact_basic", "upsert_fact_dq",
    "ambiguous_keys", "assign_ids", "distinct_rows",
    "coerce_numbers", "coerce_dates", "trim_text", "na_tokens", "split_single_column",
    "read_wrapped_feed", "read_plain_feed", "contract_violations", "table_counts",
    "rejects_by_date_rule", "rejects_by_run_rule", "rejects_last_24h", "run_rejects",
    "audit_counters", "latest_runs", "run_claims",
)
# Timed as well, but not part of the total, which stays comparable between rounds.
MORE = (
    "rule_fk_not_found", "rule_negative_amount", "rule_overpaid", "rule_date_order", "rule_bad_status",
    "coerce_datetimes", "read_bom_feed", "read_many_files", "read_delimited_feed", "read_multiline_feed",
    "added_column", "run_rejects_table",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    # The session's own start and first compilations are not part of any query.
    QUERIES["rejects_by_rule"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in (*HEADLINE, *MORE):
        begin = time.perf_counter()
        # Whole runs print their result line; standard output is for the JSON line alone.
        with contextlib.redirect_stdout(sys.stderr):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds[name] for name in HEADLINE), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
