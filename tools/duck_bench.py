"""Time the SQL of the registered queries in DuckDB, star tables built beforehand. Prints one JSON line.

usage: python tools/duck_bench.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from check import connect  # noqa: E402

from bench import HEADLINE  # noqa: E402
from cartwheel.plans.catalog import ORACLE  # noqa: E402
from cartwheel.plans.star import STAR_SQL  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.1"
    con = connect(sf_dir)
    con.execute("SET threads = 8")
    start = time.perf_counter()
    for table in ("b_orders", "b_lines", "b_prior", "b_train", "b_all", "b_departments", "b_aisles", "b_products"):
        con.execute(f"CREATE TABLE {table} AS WITH {STAR_SQL.strip()} SELECT * FROM {table}")
    seconds = {"star_build": round(time.perf_counter() - start, 3)}
    for name in args or [n for n in HEADLINE if n in ORACLE]:
        sql = ORACLE[name].replace(STAR_SQL.strip(), "b_unused AS (SELECT 1)", 1)
        times = []
        for _ in range(3):
            start = time.perf_counter()
            con.execute(sql).fetchall()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps(seconds))


if __name__ == "__main__":
    main()
