"""Write the final (post-AQE) physical plans of the headline queries to PLANS.md.

    python tools/explain_plans.py [sf_dir]

Long expression lines are cut at 240 characters; the plan shape (scans, pushed filters, read
schemas, codegen stages, exchanges, aggregates) is what the file is for.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tripspark import catalog  # noqa: E402
from tripspark.config import build_session  # noqa: E402

KEYS = [
    ("silver (one plan from the raw trips)", lambda s, d: catalog.silver_plan(s, d)),
    ("avg_duration_by_hour (flagship, on the silver table)", catalog.QUERIES["avg_duration_by_hour"]),
    ("avg_duration_one_hour_sql (bound parameter)", catalog.QUERIES["avg_duration_one_hour_sql"]),
    ("payment_analysis_sql (CTE)", catalog.QUERIES["payment_analysis_sql"]),
    ("avg_duration_by_category (grouping sets)", catalog.QUERIES["avg_duration_by_category"]),
    ("corr_matrix (blocked long-format grouped moments)", catalog.QUERIES["corr_matrix"]),
    ("null_profile (one aggregate)", catalog.QUERIES["null_profile"]),
    ("duplicate_report (one shuffle per table)", catalog.QUERIES["duplicate_report"]),
    ("preview_trips (distributed top-k)", catalog.QUERIES["preview_trips"]),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans", "", f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf_dir)}`, local[8].", ""]
    for title, fn in KEYS:
        df = fn(spark, sf_dir)
        df.collect()  # run it, so the adaptive plan shown is the final one (isFinalPlan=true)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        lines = [line if len(line) <= 240 else line[:237] + "..." for line in buf.getvalue().splitlines()]
        out += [f"## {title}", "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
