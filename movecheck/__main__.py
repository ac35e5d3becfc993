"""Command line, for ``spark-submit`` or ``python -m movecheck``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

import movecheck as mc


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="movecheck", description=mc.__doc__)
    parser.add_argument("--output", help="write the report here instead of printing it")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    profile = command("profile", "profile every column", "path")
    profile.add_argument("--format", default="orc")
    profile.add_argument("--exact-distinct", action="store_true")
    profile.add_argument("--text-sizes", action="store_true", help="sizes by the signed text rule")

    drift = command("drift", "compare the schemas of two partitions", "old", "new")
    drift.add_argument("--format", default="orc")
    drift.add_argument("--aligned", help="write the old partition in the new types here")

    compare = command("reconcile", "compare files under a contract with a table", "path", "contract")
    compare.add_argument("--format", default="orc")
    compare.add_argument("--table", help="path of the table")
    compare.add_argument("--table-format", default="parquet")
    compare.add_argument("--table-option", action="append", default=[], metavar="NAME=VALUE")
    compare.add_argument("--multiset", action="store_true")
    compare.add_argument("--tolerance-scale", type=int)
    compare.add_argument("--sample", type=int, default=5)

    load = command("load", "load files under a contract, then compare", "path", "contract", "target")
    load.add_argument("--format", default="orc")
    load.add_argument("--target-format", default="parquet")
    load.add_argument("--target-option", action="append", default=[], metavar="NAME=VALUE")
    load.add_argument("--mode", default="append")
    load.add_argument("--partition-by")
    load.add_argument("--cluster-by", default="", help="columns, separated by commas")
    load.add_argument("--decimal", help="precision,scale for decimal columns")
    load.add_argument("--strict", action="store_true", help="write nothing if values would be lost")
    return parser


def _report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.command == "profile":
        frame = mc.read_table(spark, args.path, args.format)
        if args.text_sizes:
            return mc.text_digit_profile(frame)
        return mc.profile_columns(frame, exact_distinct=args.exact_distinct)
    if args.command == "drift":
        report, aligned, _ = mc.align_partitions(spark, args.old, args.new, args.format)
        if args.aligned:
            mc.write_table(aligned, args.aligned, args.format, mode="errorifexists")
        return report
    contract = mc.load_contract(spark, args.contract)
    if args.command == "reconcile":
        found = mc.compare_with_table(
            spark, args.path, contract, args.table, args.format, args.table_format,
            _pairs(args.table_option), args.multiset, args.tolerance_scale,
        )
        return found.report(args.sample)
    done = mc.migrate(
        spark, args.path, contract, args.target, args.format, args.target_format, args.mode,
        args.partition_by, [c for c in args.cluster_by.split(",") if c],
        tuple(int(n) for n in args.decimal.split(",")) if args.decimal else None,
        args.strict, write_options=_pairs(args.target_option),
    )
    return done.difference.report()


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"movecheck {args.command}").getOrCreate()
    report = _report(spark, args)
    if args.output:
        mc.write_table(report, args.output, mode="errorifexists")
    else:
        # All of it: one row per column, or the sample that was asked for.
        report.show(max(report.count(), 1), truncate=False)


if __name__ == "__main__":
    main()
