"""Headline timings as one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores. The daily steps read
the tables that ``model_build`` wrote, as they do in production.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rootlens.operators import decomposition as dec  # noqa: E402
from rootlens.operators import detection as det  # noqa: E402
from rootlens.operators import marts as mt  # noqa: E402
from rootlens.operators import narrative as nar  # noqa: E402
from rootlens.operators import profiling as prof  # noqa: E402
from rootlens.operators import quality as qa  # noqa: E402
from rootlens.plans import daily_run as run  # noqa: E402
from rootlens.plans import onboarding as onb  # noqa: E402
from rootlens.session import local_session, scratch_dir  # noqa: E402
from rootlens.sources import sinks, star  # noqa: E402
from rootlens.spec import RETAIL  # noqa: E402

STAMP = "2024-01-01 00:00:00"
METRICS = list(RETAIL.metrics)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("rootlens-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_dir(spark)

    def marts():
        return mt.build_marts(star.read_raw(spark, sf_dir))

    def model_build():
        store = sinks.store_under(f"{base}/marts")
        return mt.build_marts(star.read_raw(spark, sf_dir), store)

    consume(star.read_table(spark, sf_dir, "region"))  # start the session outside the clock
    tables: dict = {}

    def timed_build():
        tables.update(model_build())

    def all_pairs():
        return dec.decompose(tables, RETAIL, ["total_revenue", "order_count"])

    def all_narratives():
        store = sinks.store_under(f"{base}/narratives")
        d = dec.decompose(tables, RETAIL, ["total_revenue"], store=store)
        consume(nar.narratives(d.totals, d.top, dec.top_driver(d.top), STAMP))

    def investigate_all():
        store = sinks.store_under(f"{base}/investigation")
        d = dec.decompose(tables, RETAIL, ["total_revenue"], store=store)
        consume(run.investigate(d).evidence)

    def latest_pair():
        pair = dec.latest_pair(tables[RETAIL.fact_table])
        consume(dec.decompose(tables, RETAIL, ["total_revenue"], pair).top)

    def daily():
        store = sinks.store_under(f"{base}/daily")
        consume(run.daily_run(tables, RETAIL, ["total_revenue"], STAMP, store=store).report)

    # the reference's two parts apart: the first call profiles and assigns roles, the
    # second one, with the roles stored, generates the tables and reconciles them
    def onboard():
        events = star.read_table(spark, sf_dir, "events")
        onb.onboard(events, "events", f"{base}/onboard", exact_scale=2)

    def one_narrative():
        d = tables["_pair"]
        consume(nar.narratives(d.totals, d.top, dec.top_driver(d.top), STAMP))

    def stored_pair():
        store = sinks.store_under(f"{base}/one-pair")
        pair = dec.latest_pair(tables[RETAIL.fact_table])
        tables["_pair"] = dec.decompose(tables, RETAIL, ["total_revenue"], pair, store)

    steps = {
        "fact_daily_metrics": lambda: consume(marts()["fact_daily_metrics"]),
        "metric_by_geography": lambda: consume(marts()["metric_by_geography"]),
        "metric_by_product": lambda: consume(marts()["metric_by_product"]),
        "metric_by_payment": lambda: consume(marts()["metric_by_payment"]),
        "model_build": timed_build,
        "quality_suite": lambda: consume(qa.run_checks(tables)),
        "detect_30_days": lambda: consume(det.run_detection(tables[RETAIL.fact_table], METRICS).scored),
        "detect_all_days": lambda: consume(
            det.detect_anomalies(det.long_metrics(tables[RETAIL.fact_table], METRICS))
        ),
        "decompose_latest_pair": latest_pair,
        "decompose_all_pairs": lambda: consume(all_pairs().top),
        "narratives_all_pairs": all_narratives,
        "investigate_all_pairs": investigate_all,
        "daily_run": daily,
        "decompose_and_store_one_pair": stored_pair,
        "narrative_one_pair": one_narrative,
        "onboard_events": onboard,
        "generate_and_reconcile_events": onboard,
        "profile_lineitem": lambda: consume(prof.profile_columns(star.read_table(spark, sf_dir, "lineitem"))),
        "profile_lineitem_sketched": lambda: consume(
            prof.profile_columns(star.read_table(spark, sf_dir, "lineitem"), sketches=True)
        ),
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}
        )
    )


if __name__ == "__main__":
    main()
