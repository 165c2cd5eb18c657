"""spark-submit entry points: ``jobs.py generate ...``, ``jobs.py append ...`` and ``jobs.py export ...``."""

from __future__ import annotations

import argparse
import datetime
from collections.abc import Sequence

from pyspark.sql import SparkSession

from rosterloom.plans.export import export_flat
from rosterloom.plans.append import append_month, start_panel
from rosterloom.plans.org import Organisation, build_organisation, default_blocks
from rosterloom.plans.panel import generate_panel
from rosterloom.plans.roster import PanelSpec, numbered_slots
from rosterloom.session import tune
from rosterloom.sources.panel_io import read_panel, stored_periods, write_panel
from rosterloom.sources.staging import scratch


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rosterloom")
    jobs = top.add_subparsers(dest="job", required=True)
    gen = jobs.add_parser("generate", help="write a synthetic panel to Parquet")
    gen.add_argument("--n", type=int, default=20_000, help="employees per snapshot")
    gen.add_argument("--months", type=int, default=6)
    gen.add_argument("--start", type=datetime.date.fromisoformat, default=PanelSpec().start)
    gen.add_argument("--seed", type=int, default=PanelSpec().seed)
    gen.add_argument("--out", required=True)
    gen.add_argument("--state", help="keep the state from which later months are appended")
    more = jobs.add_parser("append", help="add the next months to a panel that was generated with --state")
    more.add_argument("--n", type=int, default=20_000, help="employees per snapshot, as generated")
    more.add_argument("--months", type=int, default=1, help="how many to add")
    more.add_argument("--seed", type=int, default=PanelSpec().seed, help="as generated")
    more.add_argument("--out", required=True)
    more.add_argument("--state", required=True)
    flat = jobs.add_parser("export", help="write a flat copy with arrays as JSON text")
    flat.add_argument("--parquet", required=True)
    flat.add_argument("--out", required=True)
    flat.add_argument("--sample-employees", type=int, help="keep only N random employees, with all their months")
    flat.add_argument("--seed", type=int, default=PanelSpec().seed)
    return top


def _organisation(spark: SparkSession, seed: int) -> Organisation:
    return build_organisation(default_blocks(spark), seed, 5)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = tune(spark or SparkSession.builder.appName(f"rosterloom {args.job}").getOrCreate())
    if args.job == "generate":
        spec = PanelSpec(start=args.start, months=args.months, seed=args.seed)
        with scratch(spark):
            if args.state:
                start_panel(spark, numbered_slots(spark, args.n), _organisation(spark, args.seed), spec, args.out, args.state)
            else:
                write_panel(generate_panel(spark, args.n, spec), args.out)
    elif args.job == "append":
        known = stored_periods(spark, args.out)
        spec = PanelSpec(start=known[0], months=len(known) + args.months, seed=args.seed)
        slots, org = numbered_slots(spark, args.n), _organisation(spark, args.seed)
        for month in range(len(known), spec.months):
            with scratch(spark):
                append_month(spark, slots, org, spec, month, args.out, args.state)
    else:
        export_flat(read_panel(spark, args.parquet), args.out, n_members=args.sample_employees, seed=args.seed)


if __name__ == "__main__":
    main()
