"""Run every query against its SQL: ``python tests/check_all.py FOLDER [name part ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from comparison import connect, differences  # noqa: E402

from spreadlab.catalog import all_checks, all_queries  # noqa: E402
from spreadlab.session import local_session  # noqa: E402


def main():
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session("8"), connect(folder)
    spark.conf.set("spark.sql.ui.explainMode", "simple")
    checks, failed = all_checks(), []
    for name, build in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in checks:
                n, problems = differences(build(spark, folder), con, checks[name])
            else:
                n, problems = build(spark, folder).count(), []
        except Exception as error:  # report and go on with the next query
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:1200]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        verdict = "ok  " if not problems else "FAIL"
        print(f"{verdict} {name} rows={n} {time.time() - start:.1f}s {'' if name in checks else '(rows only)'}", flush=True)
        for p in problems:
            print("      ", p[:1500], flush=True)
        if problems:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


main()
