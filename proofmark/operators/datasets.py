"""Evaluation-dataset lifecycle on a change log: merge, as-of, history, diff, snapshot, retention.

A dataset is an append-only table of record versions. A merge writes only the rows it changes, so
its cost follows the new rows plus one look-up of the current state.
"""

from __future__ import annotations

import datetime
import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark import schemas
from proofmark.functions import text
from proofmark.operators import similarity
from proofmark.operators.filters import record_id, trace_to_record
from proofmark.operators.ranking import keep_last
from proofmark.session import written

_EXPECTATION_FIELDS = schemas.EXPECTATION_FIELDS
_PAYLOAD = ["inputs", "outputs", "expectations", "tags"]


def with_record_id(records: DataFrame) -> DataFrame:
    return records.withColumn("record_id", record_id(F.col("inputs")))


def _digest(prefix: str = "") -> Column:
    return F.sha2(F.to_json(F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in _PAYLOAD])), 256)


def dataset_as_of(change_log: DataFrame, version: int | None = None) -> DataFrame:
    """State of every record at a version (the newest by default)."""
    upto = change_log if version is None else change_log.where(F.col("version") <= version)
    # The newest version of a record is an aggregate over two narrow columns; payloads are read once and never sorted.
    newest = upto.groupBy("record_id").agg(F.max("version").alias("version"))
    return upto.join(newest, ["record_id", "version"]).select(*upto.columns)


def _one_per_record(records: DataFrame, order: str | None) -> DataFrame:
    """The last of several incoming rows for one record; without an order, the greatest digest."""
    ranked = records.withColumn("_o", F.col(order) if order else _digest())
    return keep_last(ranked.select("record_id", *_PAYLOAD, "_o"), ["record_id"], ["_o"]).drop("_o")


def _merged(joined: DataFrame, version: int) -> DataFrame:
    """What incoming rows, joined with the state of their records (old_ columns), append as a version."""
    known = F.col("old_inputs").isNotNull()
    facts = F.struct(
        *[
            F.coalesce(F.col(f"expectations.{f}"), F.col(f"old_expectations.{f}")).alias(f)
            for f in _EXPECTATION_FIELDS
        ]
    )
    no_tags = F.create_map().cast(schemas.TAGS)
    tags = F.map_zip_with(
        F.coalesce("old_tags", no_tags), F.coalesce("tags", no_tags), lambda _, old, new: F.coalesce(new, old)
    )
    merged = joined.select(
        "record_id",
        "inputs",
        F.coalesce("outputs", "old_outputs").alias("outputs"),
        F.when(F.coalesce("expectations", "old_expectations").isNotNull(), facts).alias("expectations"),
        tags.alias("tags"),
        *[f"old_{c}" for c in _PAYLOAD],
        F.when(known, "update").otherwise("insert").alias("op"),
    )
    changed = ~known | (_digest() != _digest("old_"))
    return merged.where(changed).select("record_id", *_PAYLOAD, F.lit(version).alias("version"), "op")


def merge_records(change_log: DataFrame, records: DataFrame, version: int, order: str | None = None) -> DataFrame:
    """Rows that an upsert of ``records`` appends as ``version``.

    Non-null incoming fields overwrite, tags are joined key by key, and a record that would not
    change is left out: merging the same rows twice appends nothing.
    """
    incoming = _one_per_record(records, order)
    current = dataset_as_of(change_log).select("record_id", *[F.col(c).alias(f"old_{c}") for c in _PAYLOAD])
    return _merged(incoming.join(current, "record_id", "left"), version)


def empty_log(spark: SparkSession) -> DataFrame:
    """A change log without rows, which the optimizer sees to be empty."""
    fields = spark.createDataFrame([], schemas.CHANGE_LOG).schema.fields
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where(F.lit(False))


def merge_traces(change_log: DataFrame, traces: DataFrame, version: int) -> DataFrame:
    """Upsert of records made from traces; the newest trace of a question wins."""
    return merge_records(change_log, trace_to_record(traces), version, order="request_ms")


def parse_expectations(c: str | Column) -> Column:
    """Expectations given as JSON text."""
    return F.from_json(text.col(c), schemas.EXPECTATIONS)


def annotate_records(current: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ground truth to existing records; labels carry expectations as text or as a struct.

    Fields that the label leaves out keep their value. Of several labels for a record the last counts: by ``created_ms``
    where labels have it, else the greatest as JSON text.
    """
    if isinstance(labels.schema["expectations"].dataType, T.StringType):
        labels = labels.withColumn("expectations", parse_expectations("expectations"))
    named = {f.name for f in labels.schema["expectations"].dataType.fields}
    order = "created_ms" if "created_ms" in labels.columns else F.to_json("expectations")
    truth = keep_last(labels.select("record_id", F.col("expectations").alias("_truth"), F.col(order).alias("_o") if isinstance(order, str) else order.alias("_o")), ["record_id"], ["_o"]).drop("_o")
    fields = [
        F.coalesce(F.col(f"_truth.{f}"), F.col(f"expectations.{f}")).alias(f) if f in named else F.col(f"expectations.{f}").alias(f)
        for f in _EXPECTATION_FIELDS
    ]
    return current.join(truth, "record_id", "left").withColumn(
        "expectations", F.when(F.col("_truth").isNotNull(), F.struct(*fields)).otherwise(F.col("expectations"))
    ).drop("_truth")


def dataset_history(change_log: DataFrame) -> DataFrame:
    return change_log.groupBy("version").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("op") == "insert").alias("n_inserted"),
        F.count_if(F.col("op") == "update").alias("n_updated"),
    )


def history_top(change_log: DataFrame, n: int = 5) -> DataFrame:
    return dataset_history(change_log).orderBy(F.desc("version")).limit(n)


def dataset_diff(change_log: DataFrame, v1: int, v2: int) -> DataFrame:
    """What changed between two versions, from one aggregate over digests."""
    def state(v: int) -> Column:
        return F.max_by("_d", F.when(F.col("version") <= v, F.col("version")))

    at = (
        change_log.select("record_id", "version", _digest().alias("_d"))
        .groupBy("record_id")
        .agg(state(v1).alias("a"), state(v2).alias("b"))
    )
    change = (
        F.when(F.col("a").isNull() & F.col("b").isNotNull(), "added")
        .when(F.col("a").isNotNull() & F.col("b").isNull(), "removed")
        .when(F.col("a") != F.col("b"), "changed")
    )
    return at.select("record_id", change.alias("change")).where(F.col("change").isNotNull())


def synthesize(docs: DataFrame, per_doc: int = 2, n: int | None = None, seed: str = "7") -> DataFrame:
    """Question and fact rows grounded in documents, spread evenly over them.

    Sentences are picked per document in hash order, so a run is repeatable; the fact is the sentence
    itself. With ``n``, first picks of all documents come before second picks. Rewriting questions by
    a model is left to ``proofmark.operators.harness.predict_local``.
    """
    picked = (
        docs.withColumn("_s", text.sentences("content"))
        .select(
            "doc_uri",
            F.posexplode(
                F.slice(
                    F.array_sort(
                        F.transform(
                            "_s",
                            lambda s, i: F.struct(
                                F.md5(F.concat_ws("/", F.lit(seed), F.col("doc_uri"), i.cast("string"))).alias("h"),
                                F.trim(s).alias("fact"),
                            ),
                        )
                    ),
                    1,
                    per_doc,
                )
            ).alias("pick", "p"),
        )
    )
    rows = picked.select(
        "doc_uri", "pick", F.col("p.h").alias("h"), F.col("p.fact").alias("fact"),
        F.concat(F.lit("What does "), "doc_uri", F.lit(" state about "), F.coalesce(F.get(text.tokens("p.fact"), F.lit(0)), F.lit("it")), F.lit("?")).alias("question"),
    )
    if n is not None:
        rows = rows.orderBy("pick", "h").limit(n)
    return rows.select("doc_uri", "pick", "question", "fact")


def question_diversity(records: DataFrame, threshold: float = 0.8, most: int = similarity.MOST) -> DataFrame:
    """How often each question's term set recurs, and whether a reworded question is in the set as well.

    Questions are compared by their sets of content terms: equal sets are one class, named by its least record id, and two
    classes are reworded twins at a Jaccard similarity of ``threshold`` or more. Rows (record_id, class_id, n_same, reworded,
    first_like): first_like is the least class among the record's own and its twins, so keeping the rows where it is the
    record's own id drops what rewords an earlier question. A question without content terms, or null, is a class with all
    others of its kind and has no twin. A null record_id names no class before others do.
    """
    asked = records.select("record_id", F.array_sort(F.coalesce(text.content_terms("question"), F.array().cast("array<string>"))).alias("_terms"))
    asked = asked.withColumn("_set", F.sha2(F.to_json("_terms"), 256))
    sets = written(
        asked.groupBy("_set").agg(F.any_value("_terms").alias("terms"), F.min("record_id").alias("class_id"), F.count("*").alias("n_same")), "question-sets"
    )
    like = similarity.twins(sets.where((F.size("terms") > 0) & F.col("class_id").isNotNull()).select(F.col("class_id").alias("id"), "terms"), threshold, most)
    known = sets.join(like.withColumnRenamed("id", "class_id"), "class_id", "left")
    return asked.select("record_id", "_set").join(known.drop("terms"), "_set").select(
        "record_id", "class_id", "n_same", F.when(F.col("first").isNotNull(), "yes").otherwise("no").alias("reworded"),
        F.coalesce("first", "class_id").alias("first_like"),
    )


def one_term_twins(records: DataFrame) -> DataFrame:
    """How often each question's term set recurs, and whether a twin one term apart exists.

    Two questions are reworded twins when their content-term sets differ by one term added, dropped
    or swapped (sets of three terms or more). Instead of comparing pairs, each distinct term set is
    filed under itself and under itself less one term; sets that meet under a key are twins. Work is
    linear in the terms, and a key keeps only its least and greatest member.
    """
    def set_hash(salt: str) -> Column:
        return F.aggregate("_terms", F.lit(0).cast("bigint"), lambda acc, t: acc.bitwiseXOR(F.xxhash64(t, F.lit(salt))))

    asked = records.select("record_id", text.content_terms("question").alias("_terms")).select(
        "record_id", "_terms", F.struct(F.size("_terms").alias("n"), set_hash("a").alias("a"), set_hash("b").alias("b")).alias("sig")
    )
    sets = asked.groupBy("sig").agg(F.count("*").alias("n_same"), F.any_value("_terms").alias("_terms"))

    less_one = F.when(
        F.size("_terms") >= 3,
        F.transform(
            "_terms",
            lambda t: F.struct(
                (F.col("sig.n") - 1).alias("n"),
                F.col("sig.a").bitwiseXOR(F.xxhash64(t, F.lit("a"))).alias("a"),
                F.col("sig.b").bitwiseXOR(F.xxhash64(t, F.lit("b"))).alias("b"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<n:int,a:bigint,b:bigint>>"))
    filed = sets.where(F.size("_terms") >= 2).select("sig", F.explode(F.concat(F.array("sig"), less_one)).alias("key"))
    shared = filed.groupBy("key").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi")).where(F.col("lo") != F.col("hi"))
    twins = filed.join(shared.select("key"), "key", "left_semi").select("sig").distinct().withColumn("_twin", F.lit(True))
    marked = sets.select("sig", "n_same").join(twins, "sig", "left")
    return asked.select("record_id", "sig").join(marked, "sig", "left").select(
        "record_id", "n_same", F.when(F.col("_twin"), "yes").otherwise("no").alias("reworded")
    )


def redact_records(records: DataFrame, *columns: str) -> DataFrame:
    return records.withColumns({c: text.redact(c) for c in columns})


def expire(log: DataFrame, as_of_ms: int, days: int) -> DataFrame:
    """Rows inside the time to live; a bound on the partition column prunes whole days."""
    return log.where(F.col("event_date") >= F.to_date(F.timestamp_millis(F.lit(as_of_ms - days * 86_400_000))))


def retain(spark: SparkSession, path: str, as_of_ms: int, days: int) -> DataFrame:
    """Delete the day folders of a log that lie before its time to live; returns the log as it is left.

    Only folder names are read, so the cost follows the number of days. A job that dies half-way may be run again.
    """
    first = datetime.datetime.fromtimestamp((as_of_ms - days * 86_400_000) / 1000, datetime.timezone.utc).date().isoformat()
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("event_date=") and name.removeprefix("event_date=") < first:
            fs.delete(status.getPath(), True)
    return spark.read.parquet(path)


def retention_counts(log: DataFrame, as_of_ms: int, days: int) -> DataFrame:
    kept = F.col("event_date") >= F.to_date(F.timestamp_millis(F.lit(as_of_ms - days * 86_400_000)))
    return log.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("expired"))


#: Folders that a dataset's versions are cut into by record, and buckets of a base within each.
PARTS = 8
BUCKETS = 16


def _part() -> Column:
    return F.pmod(F.xxhash64("record_id"), F.lit(PARTS)).cast("int")


class Dataset:
    """A named dataset in a shared folder: one directory per committed version, and bases that sum versions up.

    A version is written to its own directory and counts only once the writer's success marker is
    there, so a lost job leaves no half version behind and may be run again. One writer at a time.

    ``compact`` writes the state at a version as a base: a table bucketed by record. What is read later starts from the newest
    finished base at or before the version asked for, so its cost follows the base and the versions since. A merge reads the
    parts of the base that its records fall into and joins them where they lie, without a shuffle of the base.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.path = spark, f"{root}/{name}"
        jvm = spark.sparkContext._jvm
        self._dir = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._dir.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @classmethod
    def create_or_get(cls, spark: SparkSession, root: str, name: str) -> Dataset:
        dataset = cls(spark, root, name)
        dataset._fs.mkdirs(dataset._dir)
        return dataset

    def _finished(self, folder: str) -> list[int]:
        at = self._dir.suffix(folder)
        if not self._fs.exists(at):
            return []
        found = []
        for status in self._fs.listStatus(at):
            label = status.getPath().getName()
            if label.startswith("v=") and self._fs.exists(status.getPath().suffix("/_SUCCESS")):
                found.append(int(label[2:]))
        return sorted(found)

    def versions(self) -> list[int]:
        return self._finished("")

    def bases(self) -> list[int]:
        """Versions whose state is summed up in a base."""
        return self._finished("/base")

    def _log(self, versions: list[int], parts: list[int] | None = None) -> DataFrame:
        if not versions:
            return empty_log(self.spark)
        log = self.spark.read.schema(f"{schemas.CHANGE_LOG}, part INT").option("basePath", self.path).parquet(*[f"{self.path}/v={v}" for v in versions])
        return (log if parts is None else log.where(F.col("part").isin(parts))).drop("part", "v")

    def change_log(self) -> DataFrame:
        """All versions, those before a base included."""
        return self._log(self.versions())

    def _base(self, version: int) -> DataFrame:
        """A base as a bucketed table; its name is known to this session only, its files say all."""
        name = f"base_{hashlib.sha1(self.path.encode()).hexdigest()}_{version}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({schemas.CHANGE_LOG}, part INT) USING parquet PARTITIONED BY (part) "
                f"CLUSTERED BY (record_id) SORTED BY (record_id) INTO {BUCKETS} BUCKETS LOCATION '{self.path}/base/v={version}'"
            )
            self.spark.catalog.recoverPartitions(name)
        return self.spark.table(name)

    def _since_base(self, version: int | None) -> tuple[int | None, list[int]]:
        """The base to start from, and the versions to add to it."""
        upto = [v for v in self.versions() if version is None or v <= version]
        base = max((b for b in self.bases() if version is None or b <= version), default=None)
        return base, [v for v in upto if base is None or v > base]

    def compact(self, version: int | None = None) -> int:
        """Write the state at a version (the newest by default) as a base, once. Versions stay: history reads them."""
        found = [v for v in self.versions() if version is None or v <= version]
        if not found:
            raise ValueError("nothing to compact")
        if found[-1] not in self.bases():
            state = self.as_of(found[-1]).withColumn("part", _part()).repartition(BUCKETS, "record_id")
            name = f"compacting_{uuid.uuid4().hex}"
            writer = state.write.format("parquet").mode("overwrite").partitionBy("part").bucketBy(BUCKETS, "record_id").sortBy("record_id")
            writer.option("path", f"{self.path}/base/v={found[-1]}").saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        return found[-1]

    def _commit(self, rows: DataFrame, version: int) -> int:
        rows.withColumn("part", _part()).write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/v={version}")
        return version

    def next_version(self) -> int:
        return max(self.versions(), default=0) + 1

    def _merge(self, records: DataFrame, order: str | None) -> int:
        version = self.next_version()
        base, since = self._since_base(None)
        if base is None:
            return self._commit(merge_records(self._log(since), records, version, order), version)
        incoming = written(_one_per_record(records, order), "incoming")
        parts = sorted(r.part for r in incoming.select(_part().alias("part")).distinct().collect())
        return self._commit(_merged(self.with_state(incoming, base, since, parts), version), version)

    def with_state(self, incoming: DataFrame, base: int, since: list[int], parts: list[int]) -> DataFrame:
        """Incoming rows, all of some parts, with the state of their records as old_ columns: newer versions first, then the base."""
        payload = F.struct(*_PAYLOAD)
        held = self._base(base).where(F.col("part").isin(parts)).select("record_id", payload.alias("_held"))
        joined = incoming.join(held, "record_id", "left")
        if since:
            newer = dataset_as_of(self._log(since, parts)).select("record_id", payload.alias("_newer"))
            joined = joined.join(newer, "record_id", "left").withColumn("_held", F.coalesce("_newer", "_held"))
        return joined.select("record_id", *_PAYLOAD, *[F.col(f"_held.{c}").alias(f"old_{c}") for c in _PAYLOAD])

    def merge(self, records: DataFrame, order: str | None = None) -> int:
        return self._merge(with_record_id(records), order)

    def merge_traces(self, traces: DataFrame) -> int:
        return self._merge(trace_to_record(traces), "request_ms")

    def as_of(self, version: int | None = None) -> DataFrame:
        base, since = self._since_base(version)
        newer = dataset_as_of(self._log(since))
        if base is None:
            return newer
        held = self._base(base).drop("part")
        if not since:
            return held
        newer = newer.select(*held.columns)
        return held.join(newer.select("record_id"), "record_id", "left_anti").select(*held.columns).unionByName(newer)

    def history(self) -> DataFrame:
        return dataset_history(self.change_log())

    def snapshot(self, tag: str, version: int | None = None) -> str:
        """Write the state at a version under a tag, once; a finished tag is not overwritten, one that died half-way is."""
        target = f"{self.path}/snapshots/tag={tag}"
        if self._fs.exists(self._dir.suffix(f"/snapshots/tag={tag}/_SUCCESS")):
            raise ValueError(f"snapshot {tag} exists")
        self.as_of(version).write.mode("overwrite").parquet(target)
        return target
