"""Run every query beside its SQL twin: ``python -m tests.check_queries [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

from proofmark.plans import catalog
from proofmark.session import local_session
from tests import compare


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = local_session(), compare.connect(sf_dir)
    bad = 0
    for name in names or catalog.QUERIES:
        started = time.time()
        try:
            got = compare.spark_rows(catalog.QUERIES[name](spark, sf_dir))
            took, started = time.time() - started, time.time()
            sql = catalog.ORACLES.get(name)
            problem = compare.difference(got, compare.sql_rows(con, sql)) if sql else None
            note = problem or ("ok" if sql else "rows only")
        except Exception as error:  # noqa: BLE001
            took, note = time.time() - started, "ERROR " + str(error).split("JVM stacktrace")[0][:700]
            problem, got = note, ([], [])
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += bool(problem)
        print(f"{name:28s} {len(got[1]):7d} rows {took:6.2f}s sql {time.time() - started:6.2f}s  {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "-v"]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]) > 0)
