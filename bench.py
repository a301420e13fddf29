"""Headline timings. Prints one JSON line.

``q_`` names run on the given tables, adapter joins included; ``stored_`` names run on the
same movements kept by period in Parquet, the layout a real fact has. Each figure is the
median of warm runs that compute every output row. ``write_fact`` is one cold write, given
beside the total and no part of it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tamiz.operators import alerts as al
from tamiz.operators import availability as av
from tamiz.operators import premium, scorecard, uniqueness
from tamiz.operators import universe as un
from tamiz.operators.counts import rule_report
from tamiz.plans.alerts import alerts
from tamiz.plans.cube import quality_cube
from tamiz.rules import default_rules
from tamiz.session import tune, work_path
from tamiz.sources.movements import read_movements, write_movements
from verification.fixture import AS_OF, STAMP, movements

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def workload(m: DataFrame) -> dict[str, DataFrame]:
    measured = un.since_months(un.universe(m), AS_OF, 36)
    cube = quality_cube(m, AS_OF, stamp=STAMP)
    by_category = premium.premium_by_category(m, AS_OF)
    return {
        "rules": rule_report(measured, default_rules()),
        "uniqueness": uniqueness.uniqueness(measured),
        "availability_product": av.availability_rule4(m, AS_OF),
        "availability_month": av.availability_month(m, AS_OF),
        "load_arrival": av.load_arrival(m, AS_OF),
        "quality_cube": cube,
        "scorecard": scorecard.deltas(cube),
        "balance_alerts": al.balance_alerts(al.daily_balance(m, AS_OF)),
        "alerts": alerts(m, AS_OF, stamp=STAMP),
        "premium_source": premium.premium_by_source(m, AS_OF),
        "premium_mom": premium.mom_total(by_category),
    }


def timed(df: DataFrame) -> float:
    samples = []
    for run in range(RUNS + 1):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        if run:
            samples.append(time.perf_counter() - start)
    return round(statistics.median(samples), 3)


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("tamiz-bench")
             .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    fact = movements(spark, SF_DIR)
    seconds = {f"q_{name}": timed(df) for name, df in workload(fact).items()}

    path = work_path(spark, "bench-fact")
    start = time.perf_counter()
    write_movements(fact, path)
    seconds["write_fact"] = round(time.perf_counter() - start, 3)
    seconds |= {f"stored_{name}": timed(df) for name, df in workload(read_movements(spark, path)).items()}
    spark.stop()
    print(json.dumps({"metric": "tamiz_headline_total", "value": round(sum(s for name, s in seconds.items() if name != "write_fact"), 3), "unit": "sec",
                      "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS)}))


if __name__ == "__main__":
    sys.exit(main())
