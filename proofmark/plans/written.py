"""Queries: what writers leave behind, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from proofmark.operators import datasets, monitoring
from proofmark.plans import base
from proofmark.plans.base import ctes, query
from proofmark.plans.datasets_and_order import CHANGE_LOG, first_records, flat, second_records
from proofmark.plans.serving import EVALUATED, evaluated, live_registry
from proofmark.session import scratch_path
from proofmark.sources import files, tables


def _folder(spark) -> str:
    return scratch_path(spark, f"written-{uuid.uuid4().hex}")


@query("overwrite_sink", "SELECT doc_id, source, n_chars, lang FROM documents WHERE lang <> 'es'")
def overwrite_sink(spark, sf):
    """A second write replaces the first, partition folders included."""
    docs = tables.load(spark, sf, "documents", "doc_id", "source", "n_chars", "lang")
    target = f"{_folder(spark)}/docs"
    files.write_files(docs, target, ["lang"])
    files.write_files(docs.where(F.col("lang") != "es"), target, ["lang"])
    return spark.read.parquet(target)


@query("json_artifact_sink", ctes(EVALUATED) + "SELECT metric, value FROM eval_metrics")
def json_artifact_sink(spark, sf):
    """A run's metrics, written twice as a retry would, and read back."""
    folder, found = f"{_folder(spark)}/metrics", evaluated(spark, sf)[1]
    files.write_json(found, folder, "run-1")
    return spark.read.schema("metric STRING, value DOUBLE").json(files.write_json(found, folder, "run-1"))


def _two_merges(spark, sf) -> datasets.Dataset:
    dataset = datasets.Dataset.create_or_get(spark, _folder(spark), "answers")
    dataset.merge(first_records(spark, sf), order="outputs")
    dataset.merge(second_records(spark, sf), order="outputs")
    return dataset


@query("create_dataset", ctes(CHANGE_LOG) + "SELECT question, outputs, facts, source, category, version FROM state")
def create_dataset(spark, sf):
    """Create, merge twice, open again under the same name, and read the newest state."""
    root_and_name = _two_merges(spark, sf).path.rsplit("/", 1)
    return flat(datasets.Dataset.create_or_get(spark, *root_and_name).as_of(), "version")


@query("dataset_compaction", ctes(CHANGE_LOG) + """SELECT 1 AS as_of, question, outputs, facts, source, category, version FROM change_log WHERE version = 1
UNION ALL SELECT 2, question, outputs, facts, source, category, version FROM state""")
def dataset_compaction(spark, sf):
    """A base between two merges, a merge that changes nothing, and a base of that: both states, read through a base each."""
    dataset = datasets.Dataset.create_or_get(spark, _folder(spark), "answers")
    dataset.merge(first_records(spark, sf), order="outputs")
    dataset.compact()
    dataset.merge(second_records(spark, sf), order="outputs")
    dataset.merge(second_records(spark, sf), order="outputs")
    dataset.compact()
    states = [flat(dataset.as_of(v), "version").select(F.lit(v).alias("as_of"), "*") for v in (1, 2)]
    return states[0].unionByName(states[1])


@query("dataset_snapshot", ctes(CHANGE_LOG) + "SELECT question, outputs, facts, source, category, version FROM change_log WHERE version = 1")
def dataset_snapshot(spark, sf):
    return flat(spark.read.parquet(_two_merges(spark, sf).snapshot("weekly", 1)), "version")


def _sampled(name: str, rate: float) -> str:
    return f"('0x' || substr(md5('{name}' || trace_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < {rate}"


@query("registry", ctes(base.TRACES) + f"""SELECT 'safety' AS name, 1.0::DOUBLE AS sample_rate, 'running' AS status, count(*) FILTER ({_sampled('safety', 1.0)}) AS n_traces FROM traces
UNION ALL SELECT 'length', 0.5::DOUBLE, 'running', count(*) FILTER (environment = 'prod' AND {_sampled('length', 0.5)}) FROM traces
UNION ALL SELECT 'latency', 0.3::DOUBLE, 'stopped', count(*) FILTER (environment = 'prod' AND state = 'OK' AND {_sampled('latency', 0.3)}) FROM traces
UNION ALL SELECT 'idle', 1.0::DOUBLE, 'registered', count(*) FROM traces""")
def registry(spark, sf):
    """Every registered scorer with the number of traces that fall to it."""
    folder = f"{_folder(spark)}/registry"
    live_registry().stop("latency").save(spark, folder)
    known = monitoring.Registry.load(spark, folder)
    wanted = [
        F.count_if(monitoring.in_sample(e.name, e.sample_rate) & (F.expr(e.filter) if e.filter else F.lit(True))).alias(e.name)
        for e in known.entries()
    ]
    counts = tables.traces(spark, sf).agg(*wanted)
    listed = ", ".join(f"'{e.name}', {e.name}" for e in known.entries())
    per_name = counts.select(F.expr(f"stack({len(wanted)}, {listed}) AS (name, n_traces)"))
    return known.to_df(spark).select("name", "sample_rate", "status").join(per_name, "name")
