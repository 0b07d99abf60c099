"""Bench: headline workloads at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. Queries are forced in full with the ``noop`` sink (all
columns computed, nothing collected); the history is also written to the
partitioned target on disk, and increments of 1 / 100 / 10,000 changed keys are
merged into that stored table: as delta batches (``increment_delta_*``, with a full read after each and the
fold of the last one), and by rewriting the touched partitions (``increment_merge_*``). The curve is built inside the timings of the
history and the allocations. The text operators run with their production
parameters when their package is there.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from spanfan.functions.predicates import relevant  # noqa: E402
from spanfan.operators.allocate import build_window  # noqa: E402
from spanfan.operators.latest import latest_days  # noqa: E402
from spanfan.plans.history import load_history  # noqa: E402
from spanfan.plans.increment import append_increment, apply_increment, fold  # noqa: E402
from spanfan.plans.workloads import AS_OF, HI, LO, orders_ranges, stored_curve  # noqa: E402
from spanfan.session import local_session, remove_dir, work_dir  # noqa: E402
from spanfan.sources.target import Target  # noqa: E402


def forced(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def drop_delta(target: Target) -> None:
    """The next increment starts from the base again."""
    for n in target.batches():
        target.remove(f"{target.delta_path}/batch={n}")


def timed(action) -> float:
    t = time.time()
    action()
    return time.time() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="spanfan-bench")
    sf = sf_dir.rsplit("sf", 1)[-1]

    r = orders_ranges(spark, sf_dir)
    rel = r.filter(relevant())
    q: dict[str, float] = {}
    extra: dict[str, float] = {}

    def days(policy: str):
        return latest_days(rel, policy, as_of=AS_OF)

    def hours(strategy: str, lo=None, hi=None):
        return build_window(r, stored_curve(spark, sf_dir, r), lo, hi, "per_day", strategy, as_of=AS_OF)

    forced(days("per_day").limit(1000))  # warm-up (JVM, codegen caches)

    for policy in ("per_day", "per_segment", "per_record"):
        q[f"latest_{policy}"] = timed(lambda: forced(days(policy)))
    extra["day_rows"] = days("per_day").count()
    extra["day_rows_per_sec"] = round(extra["day_rows"] / q["latest_per_day"], 1)

    for strategy, name in (("days", "allocate_year_equi"), ("range", "allocate_year_range"),
                           ("months", "allocate_year_bucketed")):
        q[name] = timed(lambda: forced(hours(strategy, LO, HI)))
    q["history_all_years"] = timed(lambda: forced(hours("days")))
    q["history_all_years_segments_months"] = timed(lambda: forced(hours("months")))

    root = work_dir(spark, "bench-target")
    target = Target(spark, root, n_buckets=4)
    q["history_to_disk"] = timed(lambda: load_history(target, r, stored_curve(spark, sf_dir, r), as_of=AS_OF))
    extra["history_hour_rows"] = target.read().count()
    extra["history_hour_rows_per_sec"] = round(extra["history_hour_rows"] / q["history_all_years"], 1)
    extra["history_to_disk_rows_per_sec"] = round(extra["history_hour_rows"] / q["history_to_disk"], 1)

    curve = stored_curve(spark, sf_dir, r)
    keys = rel.select("point_of_delivery_ean").distinct().orderBy("point_of_delivery_ean")
    q["read_base"] = timed(lambda: forced(target.read()))
    for n in (1, 100, 10_000):
        q[f"increment_delta_{n}_keys"] = timed(lambda: append_increment(target, r, keys.limit(n), as_of=AS_OF))
        q[f"read_after_delta_{n}_keys"] = timed(lambda: forced(target.read()))
        extra[f"delta_{n}_keys_below_history"] = round(q["history_to_disk"] / q[f"increment_delta_{n}_keys"], 1)
        if n < 10_000:
            drop_delta(target)
    q["fold_10000_keys"] = timed(lambda: fold(target, 0.0))
    for n in (1, 100, 10_000):
        q[f"increment_merge_{n}_keys"] = timed(lambda: apply_increment(target, r, curve, keys.limit(n), as_of=AS_OF))
    remove_dir(spark, root)

    try:
        from spanfan.llm.queries import QUERIES as text_queries
    except ImportError:
        text_queries = {}
    for name, query in text_queries.items():
        q[name] = timed(lambda: forced(query(spark, sf_dir)))

    total = round(sum(q.values()), 3)
    out = {
        "metric": "total_query_sec",
        "value": total,
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "extra": extra,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
