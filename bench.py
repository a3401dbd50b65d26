"""Benchmark at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line:
{"metric": "warehouse_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

The workload is the source system's own: read the raw tables, build every model
of the warehouse once (shared intermediates and facts written as tables, as a
full refresh does), then run the report queries over the built marts.  After a
warm-up build over the smallest tables, the whole refresh runs ``REPEATS``
times in a fresh folder; every number is the median of its runs.

* ``raw``        reading the test tables and writing the raw shop tables
* ``table_*``    each shared table, built when the ones before it are there
* ``D..``        each model over the built tables: the time to compute it whole
* ``R.. A.. ..`` report queries over the built warehouse

``value`` = all of these together.  Every job is forced with a ``noop`` write,
so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
TABLES = ["dim_mails", "line_flavours", "int_primer_pedido", "int_costos_pedido", "int_clientes", "fct_pedidos",
          "fct_ventas_diarias", "dim_clientes"]
WARM_UP = "/root/testdata/sf0.001"


def _timed(times: dict[str, list[float]], name: str, work) -> None:
    start = time.time()
    work()
    times.setdefault(name, []).append(time.time() - start)


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def refresh(spark, sf_dir: str, times: dict[str, list[float]]) -> None:
    from conewise import catalog, registry
    from conewise.plans.warehouse import Shop
    from conewise.sources.sinks import remove_folder

    shop = Shop.from_test_tables(spark, sf_dir, fresh=True)
    _timed(times, "raw", lambda: [shop.raw[name] for name in shop.raw])
    for name in TABLES:
        _timed(times, f"table_{name}", lambda: getattr(shop, name))
    for qid, (attr, _) in registry.MODELS.items():
        _timed(times, qid, lambda: _force(registry.normalize(shop.model(attr))))
    for qid, query in catalog.ON_SHOP.items():
        _timed(times, qid, lambda: _force(registry.normalize(query(shop))))
    shop.close()
    remove_folder(spark, shop.raw.root)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from conewise.session import get_spark

    spark = get_spark(app="conewise-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    refresh(spark, WARM_UP if os.path.isdir(WARM_UP) else sf_dir, {})
    runs: dict[str, list[float]] = {}
    for _ in range(REPEATS):
        refresh(spark, sf_dir, runs)
    times = {name: round(statistics.median(t), 3) for name, t in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "warehouse_sec", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus), "repeats": REPEATS}))
    spark.stop()


if __name__ == "__main__":
    main()
