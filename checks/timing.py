"""Times the bench's queries as plain SQL in DuckDB: ``python -m checks.timing [directory]``."""

from __future__ import annotations

import json
import os
import sys
import time

from bench import HEADLINE
from checks.compare import connect
from checks.oracle import statements


def main(directory: str = "/root/testdata/sf0.1", repeats: int = 3) -> None:
    connection, sql, best = connect(directory), statements(), {}
    connection.execute(f"SET threads = {os.environ.get('BENCH_CPUS', '8')}")
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            started = time.time()
            connection.execute(sql[name]).fetchall()
            runs.append(time.time() - started)
        best[name] = round(min(runs), 2)
    print(json.dumps({"seconds": best, "total": round(sum(best.values()), 2)}))


if __name__ == "__main__":
    main(*sys.argv[1:])
