"""Benchmark the headline workloads; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3; the median is reported; a workload whose first run
     takes over BENCH_LONG seconds, default 20, runs once).

A warm-up query runs before the clock, and ``machine`` is the time of a fixed
Spark job, to compare figures of different machines.

Each query is fully evaluated with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    long = float(os.environ.get("BENCH_LONG", "20"))
    from barloom.session import get_spark
    spark = get_spark(f"local[{cpus}]", cpus)

    from barloom.functions import patterns as PT
    from barloom.functions import recurrent as RC
    from barloom.plans import features as FP
    from barloom.plans.frame import Win, sequence
    from barloom.plans.queries import flagship
    from barloom.sources import bars as BS

    def hourly_gapfill():
        return BS.gap_fill(BS.bars_hourly(spark, sf_dir), "1 hour").df

    def finite_family():
        fr = sequence(BS.bars_daily(spark, sf_dir))
        bases = ["ROC", "MOM", "APO", "AROONOSC", "CCI", "STOCH_slowk", "STOCHF_fastk", "PPO", "ULTOSC", "WILLR",
                 "TRANGE", "MFI"] + FP.MATH
        return FP.generate_all_features(fr, FP.LAGS, bases, patterns=False, time=False, cycle=False,
                                        dropna=False).df

    def recurrences(rn_mode, block_rows):
        def run():
            fr = sequence(BS.ticks_orders(spark, sf_dir), order=("ts", "seq"), rn_mode=rn_mode,
                          block_rows=block_rows)
            fr = RC.ema(fr, n=7)
            fr = RC.ema(fr, n=147)
            fr = RC.rsi(fr, n=14)
            fr = RC.kama(fr, n=30)
            fr = RC.macd(fr, fast=12, slow=26, signal=9)
            return fr.df
        return run

    def patterns_wma():
        fr = sequence(BS.bars_daily(spark, sf_dir))
        w = Win(fr.key, fr.block)
        fr = fr.add(PT.pattern_feats(w))
        fr = fr.add(PT.pattern_wma_feats(w, n=300))
        return fr.df

    workloads = {
        "flagship_hourly_latch_pnl": lambda: flagship(spark, sf_dir),
        "hourly_bars_gap_fill": hourly_gapfill,
        "finite_family_lags_7_147": finite_family,
        "recurrences_one_series_blocked": recurrences("range", 4096),
        "recurrences_one_series_single_task": recurrences("window", 1 << 30),
        "patterns_61_wma300": patterns_wma,
    }
    hourly_gapfill().write.format("noop").mode("overwrite").save()

    def fixed_job():
        t0 = time.time()
        spark.range(20_000_000).selectExpr("sum(xxhash64(id) % 1000) AS s", "max(sqrt(id))").collect()
        return time.time() - t0

    machine = round(statistics.median(fixed_job() for _ in range(3)), 3)
    only = os.environ.get("BENCH_ONLY")
    results = {}
    for name, fn in workloads.items():
        if only and only not in name:
            continue
        times = []
        for _ in range(repeat):
            t0 = time.time()
            fn().write.format("noop").mode("overwrite").save()
            times.append(time.time() - t0)
            if times[0] > long:
                break
        results[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds_headline_workloads", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus, "repeat": repeat, "machine": machine}))
    spark.stop()


if __name__ == "__main__":
    main()
