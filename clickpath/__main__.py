"""Run a report as an application: ``python -m clickpath <report> [options]``, or
``spark-submit --py-files clickpath.zip clickpath/__main__.py <report> [options]``.

Batch reports read a visit-action table (catalog name or parquet path) and write
a table (and optionally JDBC); stream reports read a Kafka topic or a folder of
log files and keep running until stopped.

Examples::

    python -m clickpath category-top10 --visits db.user_visit_action \\
        --start 2019-01-01 --end 2019-01-31 --table db.category_top10
    python -m clickpath page-flow --visits /data/uva --flow 1,2,3,4,5,6,7 --table db.flow
    python -m clickpath stream blacklist --kafka broker:9092 --topic ads \\
        --out /shared/jobs/blacklist --threshold 100
"""

from __future__ import annotations

import argparse
import inspect
import json

from clickpath.plans import reports as R
from clickpath.session import build_session
from clickpath.streaming.sources import file_lines, kafka_lines

BATCH = {
    "category-top10": R.category_top10_job,
    "category-sessions": R.category_top10_sessions_job,
    "page-flow": R.page_flow_job,
    "page-dwell": R.page_dwell_job,
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickpath", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="report", required=True)
    for name in BATCH:
        b = sub.add_parser(name)
        b.add_argument("--visits", required=True, help="table name or parquet path")
        b.add_argument("--start", help="first date, yyyy-MM-dd (blank = open)")
        b.add_argument("--end", help="last date, yyyy-MM-dd (blank = open)")
        b.add_argument("--table", help="output table (replaced)")
        if name.startswith("category"):
            b.add_argument("--task-id")
            b.add_argument("--jdbc", help='JSON: {"url": ..., "table": ..., "properties": {...}}')
        if name == "page-flow":
            b.add_argument("--flow", default="1,2,3,4,5,6,7")
        if name.startswith("page"):
            b.add_argument("--hot-rows", type=int, help="split sessions with more actions than this")
    s = sub.add_parser("stream")
    s.add_argument("job", choices=sorted(R.STREAM_JOBS))
    s.add_argument("--out", required=True, help="job folder (checkpoint and sinks), shared")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers (needs the Kafka connector)")
    src.add_argument("--files", help="folder or glob of log files")
    s.add_argument("--topic")
    s.add_argument("--trigger-seconds", type=int, default=5)
    s.add_argument("--once", action="store_true",
                   help="process everything available now, then stop (availableNow)")
    s.add_argument("--threshold", type=int, help="blacklist threshold (default 100)")
    s.add_argument("--watermark", help="e.g. '1 day', for the jobs that keep state")
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(app_name=f"clickpath-{args.report}")
    if args.report in BATCH:
        kwargs = {"start": args.start, "end": args.end, "table": args.table}
        if args.report.startswith("category"):
            kwargs.update(task_id=args.task_id, jdbc=json.loads(args.jdbc) if args.jdbc else None)
        if args.report == "page-flow":
            kwargs["flow"] = args.flow
        if args.report.startswith("page"):
            kwargs["hot_rows"] = args.hot_rows
        result = BATCH[args.report](spark, args.visits, **kwargs)
        if not args.table and not getattr(args, "jdbc", None):
            result.show(100, truncate=False)
        return
    lines = (kafka_lines(spark, args.kafka, args.topic) if args.kafka
             else file_lines(spark, args.files))
    options = {}
    if args.threshold is not None:
        options["threshold"] = args.threshold
    if args.watermark:
        options["watermark"] = args.watermark
    trigger = ({"availableNow": True} if args.once
               else {"processingTime": f"{args.trigger_seconds} seconds"})
    takes = inspect.signature(R.STREAM_JOBS[args.job].__init__).parameters
    for option in options:
        if option not in takes:
            _parser().error(f"the {args.job} job has no option --{option}")
    query, job = R.start_stream_job(spark, args.job, lines, args.out, trigger, **options)
    job.await_all(query)
    if args.once:
        job.result().show(100, truncate=False)


if __name__ == "__main__":
    main()
