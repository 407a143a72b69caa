"""Compare queries with their oracles: python tests/check.py [sf_dir] [name or prefix ...]"""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from oracle import connect, differences  # noqa: E402

from tickloom.queries import ORACLES, QUERIES  # noqa: E402
from tickloom.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            if name in ORACLES:
                problems = differences(fn(spark, sf), con, ORACLES[name])
                note = ""
            else:
                n = len(fn(spark, sf).collect())
                problems, note = ([] if n else ["no rows"]), f"rows only: {n}"
        except Exception as exc:  # report and go on
            problems, note = [f"{type(exc).__name__}: {str(exc)[:1500]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t:.1f}s {note}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"failed={failed}")
    sys.exit(bool(failed))
