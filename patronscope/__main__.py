"""Command line: ``python -m patronscope <job> --input DIR ...``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from patronscope import sources
from patronscope.operators import purchases
from patronscope.plans import jobs
from patronscope.streaming import incremental_profile, profile_entries, stream_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="patronscope", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)
    for name, text in (
        ("profile", "user profile and behaviour tables"),
        ("rfm", "RFM features, clusters and segments"),
        ("totals", "running profile totals over arriving files"),
        ("check-ids", "is every id unique"),
        ("preview", "schema and first rows"),
        ("prompts", "instruction prompts"),
    ):
        command = commands.add_parser(name, help=text)
        command.add_argument("--input", required=True)
        if name != "prompts":
            command.add_argument("--glob", help="read only files with matching names")
        if name in ("profile", "rfm", "totals", "prompts"):
            command.add_argument("--output", required=True)
        if name == "rfm":
            command.add_argument("--as-of", help="moment to measure recency from; now if absent")
            command.add_argument("--k", type=int, default=3)
            command.add_argument("--seed", type=int, default=42)
        if name == "totals":
            command.add_argument("--state", required=True, help="folder of the stream's progress")
            command.add_argument("--files-per-step", type=int, help="all at once if absent")
        if name == "profile":
            command.add_argument("--drop-sparse", action="store_true", help="leave sparse columns out")
        if name == "check-ids":
            command.add_argument("--output", help="folder for the two tables; shown if absent")
        if name == "prompts":
            command.add_argument("--end-token", required=True)
            command.add_argument("--format", default="json")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"patronscope-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.job == "prompts":
        examples = sources.scan_instructions(spark, args.input, args.format)
        jobs.run_prompts(spark, examples, args.output, args.end_token)
        return
    if args.job == "totals":
        arriving = stream_files(
            spark, args.input, sources.USER_SCHEMA, args.glob or "*", args.files_per_step
        )
        incremental_profile(profile_entries(arriving), args.output, args.state)
        return
    users = sources.scan_users(spark, args.input, glob=args.glob)
    if args.job == "profile":
        jobs.run_profile(users, args.output, drop_sparse=args.drop_sparse)
    elif args.job == "rfm":
        as_of = args.as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        moment = F.lit(as_of).cast("timestamp")
        jobs.run_rfm(users, args.output, moment, k=args.k, seed=args.seed)
    elif args.job == "check-ids":
        checks = jobs.check_ids(users)
        if args.output:
            for name, table in checks.items():
                sources.write_json(table, f"{args.output}/{name}")
        checks["unique_id_check"].show()
        if not args.output:
            count = checks["duplicate_ids"].count()
            checks["duplicate_ids"].show(truncate=False)
            if count > 20:
                print(f"20 of {count} repeated ids; --output writes them all")
    else:
        sources.describe_schema(users).show(len(users.columns), truncate=False)
        columns = ["last_login", "income", "login_history", "purchase_history"]
        sources.preview_columns(users, columns).show(truncate=False)
        parsed = purchases.expand_purchase(users)
        sources.preview_columns(parsed, parsed.columns).show(truncate=False)


if __name__ == "__main__":
    main()
