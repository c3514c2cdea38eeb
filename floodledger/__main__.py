"""Shell entry: the whole run, or the profile of landed files."""

from __future__ import annotations

import argparse

from floodledger.plans.profile import profile_entity
from floodledger.plans.warehouse import run
from floodledger.session import builder
from floodledger.sources.landing import read_csv_aligned
from floodledger.sources.sinks import overwrite
from floodledger.functions.cleaning import normalise_missing


def main() -> None:
    parser = argparse.ArgumentParser(prog="floodledger")
    commands = parser.add_subparsers(dest="command", required=True)
    full = commands.add_parser("run", help="folders of landed files to bronze, silver, gold and checks")
    full.add_argument("claims")
    full.add_argument("policies")
    full.add_argument("out")
    full.add_argument("--strict", action="store_true", help="negative amounts are failures")
    full.add_argument("--keep-going", action="store_true", help="do not stop on failed checks")
    full.add_argument("--only-new", action="store_true", help="leave out files landed before, build what they change")
    full.add_argument("--kind", choices=["csv", "json", "jsonl"], default="csv", help="CSV, one JSON page per file, or per line")
    single = commands.add_parser("profile", help="profile of landed CSV files")
    single.add_argument("entity", choices=["claims", "policies"])
    single.add_argument("source")
    single.add_argument("--out", help="write the profile as Parquet")
    options = parser.parse_args()

    spark = builder().getOrCreate()
    if options.command == "run":
        result = run(
            spark, options.claims, options.policies, options.out,
            strict=options.strict, stop_on_failure=not options.keep_going,
            only_new=options.only_new, kind=options.kind,
        )
        for table, rows in result.rows.items():
            print(f"{table}: {rows}")
    else:
        rows = normalise_missing(read_csv_aligned(spark, options.source))
        profile = profile_entity(rows, options.entity)
        if options.out:
            overwrite(profile, options.out)
        else:
            profile.orderBy("section", "column", "item").show(1000, truncate=False)


if __name__ == "__main__":
    main()
