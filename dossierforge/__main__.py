"""Command line: run all stages or one of them over a seed file, or publish a dataset."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import records as R
from .operators import validate as N
from .plans import company, stages
from .sources import tables
from .sources.keyed import KeyedTable


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dossierforge", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="all stages in order")
    run.add_argument("--resume", action="store_true", help="leave rows that a stage's table holds as they are")
    run.add_argument("--publish", action="store_true", help="write a release after the last stage")
    one = sub.add_parser("stage", help="one stage over the tables before it")
    one.add_argument("name", choices=stages.ORDER)
    one.add_argument("--company", help="this company_id only")
    one.add_argument("--limit", type=int, help="the first companies by company_id")
    one.add_argument("--dry-run", action="store_true", help="print rows as JSON lines and write nothing")
    for s in (run, one):
        s.add_argument("--input", required=True, help="seed file, a JSON array")
        s.add_argument("--data-root", required=True)
        for name in ("hits", "web", "addresses", "lifecycle"):
            s.add_argument(f"--{name}", help=f"Parquet table: {getattr(company, name.upper())}")
        s.add_argument("--offline", action="store_true", help="ask no provider, whatever is given")
        s.add_argument("--complete", metavar="MODULE:NAME", help="what opens a completion provider: a function of nothing that gives a function of a request")
        s.add_argument("--locate", metavar="MODULE:NAME", help="what opens a geocoder, in place of --addresses")
        s.add_argument("--engine", metavar="NAME=MODULE:NAME", action="append", default=[], help="what opens a search engine, in place of --hits; engines are asked in this order")
        s.add_argument("--prompts", help="folder with a file <stage>.md for each stage that asks; facts have two, fact-extraction-choice.md and fact-extraction-fallback.md")
    pub = sub.add_parser("publish")
    pub.add_argument("--input", required=True, help="dataset table")
    pub.add_argument("--out-dir", default="releases")
    pub.add_argument("--dry-run", action="store_true")
    for s in (run, pub):
        s.add_argument("--git-sha", default="unknown")
    return p


def _first(d: DataFrame, args: argparse.Namespace) -> DataFrame:
    if args.company:
        d = d.where(d.company_id == args.company)
    return d.orderBy("company_id").limit(args.limit) if args.limit is not None else d


def _loaded(name: str):
    """What MODULE:NAME stands for."""
    module, _, attribute = name.partition(":")
    try:
        return getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"{name} can't be loaded: {e}") from e


def _providers(spark: SparkSession, args: argparse.Namespace) -> dict:
    """The fields of company.Outside that come from options; nothing offline."""
    if args.offline:
        return {}
    found = {n: _loaded(v) for n in ("complete", "locate") if (v := getattr(args, n))}
    if args.engine:
        found["engines"] = {n: _loaded(v) for n, _, v in (e.partition("=") for e in args.engine)}
    if args.prompts:
        files = spark.read.text(f"{args.prompts}/*.md", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.md$", 1), "value")
        found["prompts"] = {n: text for n, text in files.collect() if n in {*stages.ORDER, "fact-extraction-choice", "fact-extraction-fallback"}}
    return found


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("dossierforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    try:
        if args.command == "publish":
            t = KeyedTable(spark, args.input)
            plan = stages.publish(t.read() if t.exists() else spark.read.parquet(args.input), args.out_dir, now, args.git_sha, dry_run=args.dry_run)
            print(json.dumps(plan.first().asDict()))
            return 0
        given = {n: spark.read.parquet(p) for n in ("hits", "web", "addresses", "lifecycle") if (p := getattr(args, n))}
        outside = company.Outside(tables.read_seed(spark, args.input), args.data_root, now, **given, **_providers(spark, args))
        if args.command == "run":
            done = company.run(spark, outside, args.resume)
            if args.publish:
                stages.publish(done["dataset-output"], f"{args.data_root}/releases", now, args.git_sha)
            result = done["dataset-output"]
        else:
            done = {n: stages.table(spark, args.data_root, n).read() for n in stages.READS.get(args.name, [])}
            outside.write = not args.dry_run
            if first := stages.READS.get(args.name):
                done[first[0]] = _first(done[first[0]], args)
            else:
                outside.seed = _first(outside.seed, args)
            result = company.functions(outside)[args.name](spark, done)
            if args.dry_run:
                for row in result.toJSON().toLocalIterator():
                    print(row)
                return 0
            t = stages.table(spark, args.data_root, args.name)
            t.upsert(result)
            result = t.read()
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    if args.command == "stage" and args.name == "global-scoring":
        for name, status, digest in result.select("name", "status", N.score_digest(F.col("scores"))).orderBy("name").toLocalIterator():
            print(f"{name}: status={status} {digest}", file=sys.stderr)
    for row in R.status_summary(result).orderBy("status").collect():
        print(f"{row['status']}={row['n']}", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
