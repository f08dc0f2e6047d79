"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_QUERIES (comma list; "all" for every registered query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tenderloom import catalog  # noqa: E402
from tenderloom.session import build_session  # noqa: E402

HEADLINE = [
    "lead_dedup", "school_leads", "hei_leads", "email_status", "clean_company", "extract_emails",
    "tender_buyers", "tender_winners", "tender_parties_strict", "target_tenders", "contracts",
    "supplier_contacts", "winner_totals", "counterparty_summary", "top_items", "erp_split",
    "erp_contacts", "erp_segment", "tiered_contact_match", "erp_enrich_last_wins", "fill_missing_only",
    "partners", "master_outreach", "job_status_rollup", "upsert_latest", "listing_cards", "hei_page",
    "page_summary_text",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in names:
        times = []
        for _ in range(runs + 1):  # the first run warms up and is not counted
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times[1:] or times), 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf,
        "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
