"""Times every query and compares it with its SQL: python -m tests.check_all [sf] [name ...]"""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from docketry.session import local_session
from tests.oracle import compare, connect


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session("8"), connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, run, oracles[name], sf_dir)
                note = "ok" if problem is None else f"DIFF {problem[:600]}"
            else:
                found = run(spark, sf_dir)
                rows = found.collect()
                problem = None if rows else "no rows"
                note = f"rows {len(rows)} {rows[:5]}"
        except Exception as error:  # noqa: BLE001
            problem, note = "error", f"ERROR {str(error)[:900]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
