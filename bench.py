"""Timings of the headline queries, as one JSON line.

The order of events is the one a deployment has: land the feed, drain it into the
raw tables, refresh the person tables, then read the model. BENCH_SF_DIR and
BENCH_CPUS choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame

from orderlens import catalog
from orderlens.operators.skew import SkewPolicy
from orderlens.plans import dashboards, insights, quality
from orderlens.plans import time_intelligence as over_time
from orderlens.plans.metrics import evaluate
from orderlens.session import local_session
from orderlens.sources import adapters

REFERENCE_TABLES = ("geolocation", "states", "category_groups", "payment_types", "country")


def scan(df: DataFrame) -> None:
    """Run the whole plan and produce every column of every row."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "orderlens-bench")
    seconds: dict[str, float] = {}

    def timed(name: str, action):
        start = time.monotonic()
        result = action()
        seconds[name] = round(time.monotonic() - start, 3)
        return result

    # three batches open every file, so an index of files would not help them
    ingest = timed("land_feed", lambda: catalog.new_ingest(spark, sf_dir, indexed=False))
    timed("full_drain", lambda: ingest.drip(size=50_000))
    source = adapters.raw_tables(spark, sf_dir)
    places = source.geolocation
    ingest.store.publish("geolocation", places)
    reference = {name: getattr(source, name) for name in REFERENCE_TABLES}
    reference["geolocation"] = ingest.store.current("geolocation")

    def mart():
        return ingest.mart(reference, skew=SkewPolicy())

    timed("refresh_customer_layer", lambda: ingest.refresh_customer_layer(mart()))
    queries = {
        "bi_sales": lambda m: m.bi_sales,
        "bi_orders": lambda m: m.bi_orders,
        "bi_customer": lambda m: m.bi_customer,
        "fact_orders": lambda m: m.fact_orders,
        "rfm": lambda m: m.rfm,
        "customer_ltv": lambda m: m.customer_ltv,
        "cohort_retention": lambda m: m.cohort,
        "category_pareto": lambda m: m.category_pareto,
        "headline_kpis": insights.headline_kpis,
        "rfm_segments": insights.rfm_segments,
        "core_metrics_by_region_year": lambda m: evaluate(
            m, catalog.CORE, ["customer_region", "purchase_year"]
        ),
        "yoy_mom": over_time.yoy_mom,
        "revenue_by_state": dashboards.revenue_by_state,
        "dq_checks": lambda m: quality.dq_checks(m, ingest.ingest_state()),
    }
    for name, build in queries.items():
        timed(name, lambda build=build: scan(build(mart())))
    print(
        json.dumps(
            {
                "metric": "total seconds, feed to reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
