"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. What a query reads besides the given tables (raw files for the
load steps, stored documents and datamarts for requests) is written before its
clock starts; refreshed_datamarts and stored_documents write inside it. A short
run first warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardloom.session import build_session  # noqa: E402
from cardloom.suite import landing  # noqa: E402
from cardloom.suite.base import Model  # noqa: E402
from cardloom.suite.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "refreshed_datamarts", "stored_documents",
    "card_datamart", "daily_datamart", "category_datamart", "client_cards", "merchant_volume",
    "enriched_flat", "enriched_documents", "fraud_categories_top", "top_cards_of_month",
    "client_risk", "card_alerts", "risky_cards", "find_transaction", "transactions_page",
    "client_transactions", "latest_per_client", "client_summary", "fraud_stats", "fraud_facets",
    "collection_report", "error_codes", "orphan_report", "quality_suite", "client_changes",
    "load_transactions", "load_labels", "load_merchants", "load_errors", "document_features", "batch_windows", "stream_windows",
)

BY_ID = ("find_transaction",)
BY_CLIENT = (
    "transactions_page", "client_transactions", "latest_per_client", "client_summary", "fraud_stats", "fraud_facets", "collection_report",
)


def prepare(m: Model, name: str) -> None:
    """Writes what the query reads, once."""
    if name in ("load_transactions", "load_merchants", "load_errors"):
        landing.transactions(m)
    elif name == "load_labels":
        landing.labels(m)
    elif name == "risky_cards":
        landing.gold(m)
    elif name in BY_ID or name in BY_CLIENT:
        landing.documents(m, by_id=name in BY_ID)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = f"{os.path.dirname(folder.rstrip('/'))}/sf0.001"
    QUERIES["card_datamart"](spark, small if os.path.isdir(small) else folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in wanted:
        prepare(Model(spark, folder), name)
        start = time.perf_counter()
        # all rows are computed and none is sent to the driver
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
