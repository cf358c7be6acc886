"""``python -m tripmill.plans.cli``: a month, a backfill, the schema change, a count at a snapshot, or the code bundle."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from tripmill.plans import bundle
from tripmill.plans.month import Lake, backfill_requests
from tripmill.plans.steps import PAUSE, RETRIES
from tripmill.session import session
from tripmill.sources.files import SourceFile, file_name
from tripmill.sources.schema import check_month


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tripmill")
    parser.add_argument("step", choices=["month", "backfill", "evolve", "snapshot", "bundle"])
    parser.add_argument("--root", help="URI of the tables")
    parser.add_argument("--landing", help="URI of the folder with the monthly files")
    parser.add_argument("--zones", help="URI of the zone lookup")
    parser.add_argument("--year", type=int, default=2024)
    parser.add_argument("--month", type=int, default=1)
    parser.add_argument("--snapshot-id", help="of the bronze trips")
    parser.add_argument("--retries", type=int, default=RETRIES, help="of each step of a month")
    parser.add_argument("--pause", type=float, default=PAUSE, help="seconds before a retry")
    parser.add_argument("--take-over", action="store_true", help="begin although a crashed run still holds the tables")
    parser.add_argument("--output", type=Path, help="of the bundle")
    args = parser.parse_args(argv)
    if args.step == "bundle":
        print(json.dumps(bundle.build(args.output or Path("dist/tripmill.zip")), sort_keys=True))
        return
    if not args.root:
        parser.error(f"{args.step} needs --root")
    spark = session()
    lake = Lake(spark, args.root)
    if args.step == "evolve":
        lake.evolve()
        said = [{"evolved": True}]
    elif args.step == "snapshot":
        check_month(args.year, args.month)
        rows = lake.bronze.read(args.snapshot_id, _source_year=args.year, _source_month=args.month).count()
        said = [{"snapshot_id": args.snapshot_id, "row_count": rows}]
    else:
        months = backfill_requests(args.year, args.month) if args.step == "backfill" else [(args.year, args.month)]
        months = [(m.year, m.month) if hasattr(m, "year") else m for m in months]
        sources = SourceFile.all_of(spark, [(y, m, f"{args.landing}/{file_name(y, m)}") for y, m in months])
        said = [lake.run(source, args.zones, args.retries, args.pause, args.take_over) for source in sources]
    for x in said:
        print(json.dumps(x, sort_keys=True))


if __name__ == "__main__":
    main()
