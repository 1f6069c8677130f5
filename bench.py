"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "map_beschikking",
    "map_beschikte_voorziening",
    "map_client",
    "map_declaratieregel",
    "map_medewerker",
    "map_wet_enum",
    "map_enum_gezinsrelatie",
    "map_natuurlijk_persoon",
    "map_ingeschreven_persoon",
    "map_verblijfsadres",
    "map_huwelijk",
    "silver_load_all",
    "scan_table",
    "bronze_typed",
    "dump_parts",
    "odata_pages",
    "landing_incremental",
    "write_replace",
    "silver_overwrite",
    "silver_upsert",
    "join_inner_composite",
    "join_or_residual",
    "domain_decode",
    "agg_group_min",
    "top1_per_group",
    "win_row_number",
    "win_running_max",
    "win_first_value",
    "win_lead",
    "interval_close",
    "fn_incomplete_date",
    "fn_local_date",
    "conform_contract",
    "pk_violations",
    "fk_orphans",
    "reconcile_values",
]


def main() -> None:
    from zilverspoor.session import build_session

    from zilverspoor import checks

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = checks.queries()
    known["map_client"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
