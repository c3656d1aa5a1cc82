"""Command line over one root folder; also the target of ``spark-submit``.

    python -m starfold build ROOT CSV [CSV ...] [--null-safe] [--seed S] [--resume]
    python -m starfold checks ROOT
    python -m starfold queries ROOT [NAME ...] [--out DIR] [--rows N]
    python -m starfold reports ROOT [NAME ...] [--out DIR] [--rows N]
    python -m starfold sql ROOT "SELECT ... FROM fact_collisions ..." [--out DIR] [--rows N]
    python -m starfold inspect ROOT TABLE
    python -m starfold expire ROOT [--keep N]

Results print N rows (20 unless given) and say how many there are; ``--out`` writes each whole result
as Parquet to DIR/NAME. ``build`` and ``checks`` end with 1 when a check failed, ``queries`` and ``reports`` when one could not be run.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame

from starfold.operators import exit_code, run_checks, summarize
from starfold.plans import CATALOG, LAYOUT, REPORTS, Lake, open_gold, open_table, run_catalog
from starfold.session import session
from starfold.sources import expire_versions, inspect, write_table

SHOWN = 20


def _result_options(command: argparse.ArgumentParser) -> None:
    command.add_argument("--out", help="folder for the whole results, as Parquet")
    command.add_argument("--rows", type=int, default=SHOWN, help="rows to print of each result")


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starfold")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build")
    build.add_argument("root")
    build.add_argument("csv", nargs="+")
    build.add_argument("--null-safe", action="store_true")
    build.add_argument("--seed", default="")
    build.add_argument("--resume", action="store_true")
    commands.add_parser("checks").add_argument("root")
    for name in ("queries", "reports"):
        command = commands.add_parser(name)
        command.add_argument("root")
        command.add_argument("names", nargs="*", metavar="NAME")
        _result_options(command)
    sql = commands.add_parser("sql")
    sql.add_argument("root")
    sql.add_argument("text")
    _result_options(sql)
    look = commands.add_parser("inspect")
    look.add_argument("root")
    look.add_argument("table", choices=list(LAYOUT))
    expire = commands.add_parser("expire")
    expire.add_argument("root")
    expire.add_argument("--keep", type=int, default=2, help="newest versions that stay readable")
    return parser.parse_args(argv)


def _report(checks: DataFrame) -> int:
    """Print the checks from one run of them."""
    rows = checks.collect()  # one per check
    kept = checks.sparkSession.createDataFrame(rows, checks.schema)
    kept.orderBy("check").show(len(rows), truncate=False)
    summarize(kept).show()
    return exit_code(kept)


def _shower(args: argparse.Namespace):
    def show(name: str, df: DataFrame) -> None:
        if args.out:
            df = write_table(df, f"{args.out.rstrip('/')}/{name}")
        else:
            df = df.cache()
        print(f"{name}: {df.count()} rows" + (f" in {args.out}" if args.out else "") + f", at most {args.rows} shown")
        df.show(args.rows, truncate=False)
        df.unpersist()

    return show


def main(argv: list[str] | None = None) -> int:
    args = _arguments(sys.argv[1:] if argv is None else argv)
    known = CATALOG if args.command == "queries" else REPORTS
    unknown = [name for name in getattr(args, "names", []) if name not in known]
    if unknown:
        print(f"unknown: {', '.join(unknown)}; known: {', '.join(known)}", file=sys.stderr)
        return 2
    spark = session()
    if args.command == "build":
        made = Lake.from_csv(
            spark, args.root, args.csv, null_safe=args.null_safe, seed=args.seed, resume=args.resume
        )
        return _report(made.run())
    if args.command == "inspect":
        inspect(open_table(spark, args.root, args.table), SHOWN)
        return 0
    if args.command == "expire":
        for path in expire_versions(spark, args.root.rstrip("/"), args.keep):
            print(f"deleted {path}")
        return 0
    gold = open_gold(spark, args.root)
    if args.command == "checks":
        return _report(run_checks({"silver": open_table(spark, args.root, "silver"), **gold.tables()}))
    if args.command == "sql":
        gold.register()
        _shower(args)("sql", spark.sql(args.text))
        return 0
    failed = run_catalog(gold, _shower(args), {name: known[name] for name in args.names or known})
    for name, error in failed.items():
        print(f"{name} failed: {error}", file=sys.stderr)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
