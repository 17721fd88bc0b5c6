"""Job entry point: ``spark-submit -m fulfilq <command>`` or ``python -m fulfilq <command>``.

Commands
  validate  quality suite on the landing data; exit 1 if an error-severity check fails
  cleanse   landing CSV -> curated Parquet (optionally only folders >= --watermark)
  load      curated -> star tables (upsert) + audit log
  marts     build the six marts from the star tables, write them under --out
  smoke     row, stamp and key checks on the curated files; exit 1 if one fails
  run       (--validate: quality suite first) cleanse + load (+ marts with --out)
"""

from __future__ import annotations

import argparse
import json
import sys

from fulfilq.plans import pipeline
from fulfilq.session import get_spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fulfilq")
    ap.add_argument("command", choices=["validate", "cleanse", "load", "marts", "smoke", "run"])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--curated", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--watermark", default=None, help="YYYY-MM-DD, or 'auto' (each target from its own mark)")
    ap.add_argument("--overlap-days", type=int, default=0, help="with 'auto': read so many days before the mark")
    ap.add_argument("--lookback-days", type=int, default=None, help="with 'auto': bound of a target without a mark")
    ap.add_argument("--validate", action="store_true", help="with 'run': stop if an error-severity check fails")
    ap.add_argument("--out", default=None, help="where marts are written")
    ap.add_argument("--expected-warehouses", default=None, help="ids that validation expects, comma-separated")
    args = ap.parse_args(argv)

    validating = args.command == "validate" or (args.command == "run" and args.validate)
    if validating and not args.expected_warehouses:
        ap.error("--expected-warehouses is required to validate")
    spark = get_spark(app_name=f"fulfilq-{args.command}")
    layout = pipeline.Layout(args.landing, args.curated, args.warehouse)
    wm = args.watermark
    if wm == "auto":
        from fulfilq.operators.audit import resolve_watermarks

        targets = [t for t, _ in pipeline.TARGETS.values()]
        wm = resolve_watermarks(spark, layout.audit, targets, args.overlap_days, args.lookback_days)

    if validating:
        rows = pipeline.validate(spark, layout, args.expected_warehouses.split(",")).collect()
        for r in rows:
            print(json.dumps(r.asDict(), default=str))
        failed = [r for r in rows if not r.passed and r.severity == "error"]
        if failed or args.command == "validate":
            return 1 if failed else 0
    if args.command == "smoke":
        rows = pipeline.smoke(spark, layout).collect()
        for r in rows:
            print(json.dumps(r.asDict(), default=str))
        return 0 if rows and all(r.passed for r in rows) else 1
    if args.command in ("cleanse", "run"):
        print(json.dumps({"cleanse": pipeline.run_cleanse(spark, layout, wm)}, default=str))
    if args.command in ("load", "run"):
        print(json.dumps({"load": pipeline.run_load(spark, layout, wm)}, default=str))
    if args.command == "marts" or (args.command == "run" and args.out):
        if not args.out:
            ap.error("--out is required for marts")
        pipeline.write_marts(pipeline.load_star(spark, layout), args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
