"""``python tests/run_queries.py [folder] [name ...]``: every query against its SQL."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from monthbook.session import build_session, clear_scratch  # noqa: E402
from suite import all_oracles, all_queries  # noqa: E402
from tests.compare import compare, duck  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="12g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf), all_oracles(), 0
    for name, fn in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                exact = compare(df, con, oracles[name])
                near = compare(df, con, oracles[name], digits=9) if exact else []
                state = "ok" if not exact else "near" if not near else "DIFFERS"
                notes = near or exact
            else:
                state, notes = "rows", [f"{len(df.collect())} rows"]
        except Exception as error:  # noqa: BLE001 - report and go on
            state, notes = "FAILS", [str(error)[:600]]
        bad += state in ("DIFFERS", "FAILS")
        clear_scratch(spark)
        print(f"{state:8}{time.time() - start:7.2f}s {name} {notes[:4] if notes else ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
