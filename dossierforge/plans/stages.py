"""The stages in order, each a function of tables; what is done already can be left out."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab as V
from ..operators import records as R
from ..sources import tables
from ..sources.keyed import KeyedTable, _Files

ORDER = ["website-resolution", "content-collection", "fact-extraction", "content-summarization", "geocoding", "tagline-extraction", "global-scoring", "tagging", "translation", "dataset-output"]
#: Stages whose tables each stage reads.
READS = {
    "content-collection": ["website-resolution"],
    "fact-extraction": ["content-collection"],
    "content-summarization": ["content-collection"],
    "geocoding": ["fact-extraction"],
    "tagline-extraction": ["content-summarization"],
    "global-scoring": ["content-summarization"],
    "tagging": ["content-summarization"],
    "translation": ["tagline-extraction", "global-scoring"],
    "dataset-output": ["fact-extraction", "geocoding", "global-scoring", "tagline-extraction", "tagging", "translation"],
}
#: This one is made anew in every run.
ALWAYS = {"dataset-output"}

StageFn = Callable[[SparkSession, Mapping[str, DataFrame]], DataFrame]


def table(spark: SparkSession, root: str, name: str) -> KeyedTable:
    """The stage's table under root."""
    return KeyedTable(spark, f"{root}/{name}")


def run(spark: SparkSession, root: str, functions: Mapping[str, StageFn], resume: bool = False) -> dict[str, DataFrame]:
    """Run the stages that functions has, in order, each to its end, and merge what they give into their tables under root.

    A key that a table holds under another name stops the run, with that table as it was. With resume, rows of keys that a stage's table holds already stay as they
    are, whatever their status. A run that dies leaves each table with its last whole version; running again gives what one run would have.
    """
    done: dict[str, DataFrame] = {}
    for name in ORDER:
        if name not in functions:
            continue
        t, inputs = table(spark, root, name), dict(done)
        if name in ALWAYS:
            t.replace(functions[name](spark, inputs))
        elif resume and t.exists():
            old = t.read()
            first = READS.get(name, [None])[0]
            if first in inputs:
                inputs[first] = R.pending(inputs[first], old)
            t.upsert(R.pending(functions[name](spark, inputs), old))
        else:
            t.upsert(functions[name](spark, inputs))
        t.vacuum()
        done[name] = t.read()
    return done


def manifest(companies: DataFrame, generated_at: str, git_sha: str) -> DataFrame:
    """One row: tag, generated_at, pipeline_git_sha, company_count, schema_version."""
    d = companies.agg(F.count("*").alias("company_count"))
    return d.select(T.release_tag(F.lit(generated_at)).alias("tag"), F.lit(generated_at).alias("generated_at"), F.lit(git_sha).alias("pipeline_git_sha"), "company_count", F.lit(V.SCHEMA_VERSION).alias("schema_version"))


def publish(companies: DataFrame, out_dir: str, generated_at: str, git_sha: str, sink=None, dry_run: bool = False) -> DataFrame:
    """Check the data, then the sink, plan, write the release to out_dir, and hand it to the sink. A tag that is taken raises and changes nothing."""
    R.require_none(R.duplicate_ids(companies), "company ids that occur twice")
    if sink is not None and not dry_run:
        sink.check()
    plan = manifest(companies, generated_at, git_sha)
    if not dry_run:
        spark = companies.sparkSession
        tag = spark.range(1).select(T.release_tag(F.lit(generated_at)).alias("t")).first()["t"]
        folder = f"{out_dir}/{tag}"
        if _Files(spark).exists(folder) or sink is not None and sink.exists(tag):
            raise ValueError(f"tag {tag} exists already (try again next second)")
        tables.export_json(companies, f"{folder}/companies")
        plan.write.mode("overwrite").json(f"{folder}/manifest")
        if sink is not None:
            sink.upload(tag, [f"{folder}/companies", f"{folder}/manifest"])
    return plan
