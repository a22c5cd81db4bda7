"""Command line: python -m oreweave {ingest,report,fuse,enrich,quality} ..."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="oreweave")
    sub = top.add_subparsers(dest="command", required=True)
    ingest = sub.add_parser("ingest", help="delimited registry to GeoParquet")
    ingest.add_argument("input")
    report = sub.add_parser("report", help="deposits of report documents as JSON")
    report.add_argument("--input", "-i", required=True)
    fuse = sub.add_parser("fuse", help="registry and reports to one dataset")
    fuse.add_argument("--csv", required=True)
    fuse.add_argument("--pdf", required=True)
    enrich = sub.add_parser("enrich", help="geology of each deposit")
    enrich.add_argument("--input", "-i", required=True)
    enrich.add_argument("--shapefile", "-s", required=True)
    ingest.add_argument("--output", "-o", required=True)
    fuse.add_argument("--output", "-o", default="unified.parquet")
    enrich.add_argument("--output", "-o", default="enriched.parquet")
    quality = sub.add_parser("quality", help="data-quality counts of a dataset")
    quality.add_argument("input")
    for p in (ingest, report, fuse, enrich, quality):
        p.add_argument("--log-level", default="INFO")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level)
    from oreweave.operators.analytics import commodity_examples, quality_report, summary
    from oreweave.plans import pipelines
    from oreweave.sources.documents import RuleExtractor
    from oreweave.sources.geoparquet import read_geoparquet

    spark = SparkSession.builder.appName("oreweave").getOrCreate()
    if args.command == "ingest":
        out = {
            "files": [r.asDict() for r in pipelines.run_ingest(spark, args.input, args.output).collect()],
            "dropped": {r["reason"]: r["n"] for r in pipelines.dropped_rows(spark, args.input).collect()},
        }
    elif args.command == "report":
        rows, rejected = pipelines.split_documents(spark, args.input, RuleExtractor())
        out = [json.loads(x) for x in rows.drop("_ord").toJSON().toLocalIterator()]
        logging.getLogger("oreweave").info("%s records rejected", rejected.count())
    elif args.command == "fuse":
        out = pipelines.run_fusion(spark, args.csv, args.pdf, RuleExtractor(), args.output).first().asDict()
    elif args.command == "quality":
        df = read_geoparquet(spark, args.input)
        out = quality_report(df).first().asDict() | {"commodity_examples": [r["commodities"] for r in commodity_examples(df).collect()]}
    else:
        pipelines.run_enrich(spark, args.input, args.shapefile, args.output)
        out = summary(read_geoparquet(spark, args.output)).first().asDict()
    print(json.dumps(out, sort_keys=True, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
