"""Command-line entry for the jobs: ``python -m lakelens.cli <job> [options]``.

Configuration comes from environment variables (``JobConfig.from_env``) plus the
flags below; paths may be any Hadoop-compatible URI.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from lakelens.config import JobConfig
from lakelens.session import build_session, shared_dir
from lakelens.streaming import jobs

JOBS = ("producer", "consumer", "processor", "batch-ingest", "lake-maintain")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lakelens")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
    parser.add_argument("--once", action="store_true", help="drain what is there and stop (availableNow)")
    parser.add_argument("--lenient", action="store_true", help="consumer: batch defaults instead of strict fields")
    parser.add_argument("--as-of", help="batch-ingest: date for the retention cutoff (default: today); "
                                        "lake-maintain: time the snapshot retention counts back from")
    parser.add_argument("--table", help="lake-maintain: change-log table path (default LAKELENS_IMAGES_TABLE)")
    parser.add_argument("--out", help="lake-maintain: path of the rewritten table")
    parser.add_argument("--max-records-per-file", type=int, help="lake-maintain: file size cap in rows")
    args = parser.parse_args(argv)

    spark = build_session(app_name=f"lakelens-{args.job}")
    cfg = JobConfig.from_env()
    # one checkpoint for each job and topic, so that a restart goes on where the last run stopped
    checkpoint = args.checkpoint or f"{shared_dir(spark)}/lakelens/checkpoints/{args.job}-{cfg.input_topic}"
    if args.job == "lake-maintain":
        from datetime import datetime, timedelta, timezone

        from lakelens.sinks import tables
        now = datetime.fromisoformat(args.as_of) if args.as_of else \
            datetime.now(timezone.utc).replace(tzinfo=None)
        cutoff = (now - timedelta(days=cfg.snapshot_retention_days)).isoformat(" ")
        tables.rewrite_lake(spark, args.table or cfg.images_table, args.out, cutoff=cutoff,
                            max_records_per_file=args.max_records_per_file)
        print(json.dumps({"expired_before": cutoff, "out": args.out}))
        return 0
    if args.job == "batch-ingest":
        counters = jobs.run_batch_ingest(spark, cfg, checkpoint, as_of=args.as_of)
        print(json.dumps(asdict(counters)))
        return 0
    start = {"producer": jobs.start_producer, "processor": jobs.start_processor}.get(args.job)
    if args.job == "consumer":
        query = jobs.start_consumer(spark, cfg, checkpoint, strict=not args.lenient, available_now=args.once,
                                    name=f"lakelens-{args.job}")
    else:
        query = start(spark, cfg, checkpoint, available_now=args.once, name=f"lakelens-{args.job}")
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
