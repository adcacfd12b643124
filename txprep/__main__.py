"""Command line for the two jobs, e.g. under spark-submit:

    python -m txprep prepare --input 's3a://bucket/raw/*.txt' --output s3a://bucket/ml_ready_data/ \\
        --report s3a://bucket/reports/prep-1
    python -m txprep profile --path s3a://bucket/ml_ready_data/ --report s3a://bucket/reports/profile-1

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings (including ``spark.checkpoint.dir``) are whatever spark-submit or
the caller configured.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans import analyze, prepare, write_reports


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="txprep")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("prepare", help="clean raw transactions into label-partitioned Parquet")
    p.add_argument("--input", required=True, help="input files (path or glob)")
    p.add_argument("--format", default="delimited", choices=("delimited", "json", "parquet"))
    p.add_argument("--output", required=True)
    p.add_argument("--method", default="exact", choices=("exact", "sketch", "approx"))
    p.add_argument("--max-output-partitions", type=int, default=None)
    p.add_argument("--min-rows", type=int, default=0, help="validated rows below which no outlier is removed")
    p.add_argument("--report", default=None, help="folder for the JSON and text reports")
    r = sub.add_parser("profile", help="profile a dataset or inventory a folder")
    r.add_argument("--path", required=True)
    r.add_argument("--kind", default="auto", choices=("auto", "dataset", "inventory"))
    r.add_argument("--label", default="tx_fraud")
    r.add_argument("--report", required=True)
    args = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"txprep-{args.job}").getOrCreate()

    if args.job == "prepare":
        res = prepare(spark, args.input, args.output, method=args.method,
                      max_output_partitions=args.max_output_partitions, source_format=args.format,
                      min_rows=args.min_rows)
        summary = {"input_rows": res.input_rows, "output_rows": res.output_rows,
                   "retention_pct": res.retention_pct, "partitions": res.partitions,
                   "waterfall": res.waterfall, "output": res.output_path}
        if args.report:
            summary["report"] = write_reports(res.to_metrics(spark), args.report,
                                              title=f"PREPARE {args.input} -> {args.output}", target=args.input)
    else:
        metrics = analyze(spark, args.path, kind="auto" if args.kind == "auto" else args.kind,
                          label=args.label)
        summary = {"report": write_reports(metrics, args.report, title=f"PROFILE {args.path}", target=args.path)}
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main(sys.argv[1:])
