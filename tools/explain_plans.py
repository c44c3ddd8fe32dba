"""Write the physical plans of the main operators to docs/PLANS.md.

Inputs are first written as Parquet tables (page log partitioned by event date
and hour, as ``write_window`` lays it out), so the plans show what a production
read looks like: partition filters, pushed filters, read schemas, exchanges and
the join strategies AQE settled on after running.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile
from datetime import date, datetime

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def final_plan(df) -> str:
    df.collect()  # runs this very query, whose adaptive plan is then final
    text = df._jdf.queryExecution().executedPlan().toString()
    # control characters of the pattern literals, shown escaped
    return "".join(c if c == "\n" or c.isprintable() else f"\\u{ord(c):04x}" for c in text)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pagetrail.operators import pages, parse, quality, views, visitors
    from pagetrail.session import get_session
    from pagetrail.sinks import tables
    from pagetrail.sources import fixtures as fx

    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "16"})
    work = tempfile.mkdtemp(prefix="pagetrail-plans-")
    pl_root = f"{work}/user_page_log"
    tables.write_window(fx.page_log(spark, fx.load(spark, sf, "events")), pl_root,
                        datetime(2024, 1, 1), datetime(2024, 2, 1))
    fx.blacklist(spark, fx.load(spark, sf, "nation")).write.parquet(f"{work}/blacklist")
    fx.raw_lines(spark, fx.load(spark, sf, "events")).write.parquet(f"{work}/lines")

    page_log = tables.read_table(spark, pl_root, "event_date DATE, event_hour INT", tables.PAGE_LOG_DDL) \
        .drop("row_added", "event_hour")
    blacklist = spark.read.parquet(f"{work}/blacklist")
    lines = spark.read.parquet(f"{work}/lines")
    h0, h1 = datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 11)

    cases = [
        ("Page log for one hour (FIL4-5, JOI1)",
         pages.user_page_log(page_log.drop("event_date"), blacklist, h0, h1)),
        ("Bounty views for one hour read through the partitioned table (SRC5, FIL6-7, PRJ1)",
         views.bounty_views(tables.read_window(spark, pl_root, h0, h1, schema=tables.PAGE_LOG_DDL)
                            .drop("row_added"), h0, h1)),
        ("Visitors with their previous visit (AGG1-2, AGG5, JOI2), partition-pruned",
         visitors.visitor_previous_visit(page_log, date(2024, 1, 15))),
        ("Parse, good rows (PRS1-15)", parse.good_rows(parse.parse_lines(lines))),
        ("Per-file quality counts (AGG4)", quality.file_quality(parse.parse_lines(lines))),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on {os.path.basename(sf)} inputs written as Parquet;",
           "final adaptive plans (after execution). Regenerate after changing an operator.", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", final_plan(df).rstrip(), "```", ""]
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
