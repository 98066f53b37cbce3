"""Time every query in Spark and its SQL in DuckDB, one after the other, warm, median of three.

usage: python tools/baseline.py SF_DIR [query ...]   (prints a Markdown table)
"""

from __future__ import annotations

import statistics
import sys
import time

import compare
from registry.queries import QUERIES


def median_of(run, times: int = 3) -> float:
    run()
    seconds = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def main() -> None:
    sf_dir = sys.argv[1].rstrip("/")
    spark, con = compare.local_session(8), compare.connect(sf_dir)
    print("| query | Spark s | DuckDB s |\n|---|---|---|")
    for name in sys.argv[2:] or QUERIES:
        ours = median_of(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        sql = compare.entry.oracle_sql().get(name)
        theirs = f"{median_of(lambda: con.execute(sql).fetchall()):.2f}" if sql else "-"
        print(f"| `{name}` | {ours:.2f} | {theirs} |", flush=True)


if __name__ == "__main__":
    main()
