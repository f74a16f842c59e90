"""Run every registered query and its SQL over one folder of tables and compare them.

    python tools/check_oracles.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.checks.compare import connect, differences  # noqa: E402
from ledgerloom.checks.queries import QUERIES  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", {"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": "8"})
    con = connect(folder)
    failed = []
    for name in names or QUERIES:
        start = time.time()
        rows, found = differences(spark, con, name, folder)
        print(f"{name:28} {rows:8} rows {time.time() - start:6.1f}s  {'DIFFERS' if found else 'ok'}", flush=True)
        for line in found:
            print("   ", line)
        if found:
            failed.append(name)
    print("failed:", failed or "none")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
