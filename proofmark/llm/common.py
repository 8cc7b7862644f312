"""Helpers the training-text operators share: scans, written intermediates, safe cuts of long texts, Arrow batches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.session import scratch_path

#: Unicode's White_Space characters, as text.
SPACES = "\t-\r \x85\xa0  -     　"
_CUT = re.compile(f"(?<=[^{SPACES}])(?=[{SPACES}])")
#: The six characters that separate words in the stated word rule [^\x20\x09-\x0D]+.
WORD_GAPS = " \t\n\x0b\x0c\r"

# Batches of bounded size, whatever the length of the rows.
BATCH_ROWS = "1000"
BATCH_BYTES = str(16 << 20)


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that reach Python workers."""
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder and read it back.

    It survives lost executors, cuts the lineage, and its size on disk tells the planner how large it is.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name the table does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text's UTF-8 bytes (null: empty), under fixed names: other columns cannot clash."""
    return df.select(
        col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).cast("string").cast("binary").alias("body")
    )


def add_fields(df: DataFrame, names: list[str], fields: str) -> T.StructType:
    """Schema of some columns of a table followed by new ones."""
    given = [next(f for f in df.schema.fields if f.name == n) for n in names]
    return T.StructType(given + T._parse_datatype_string(fields).fields)


def per_batch(fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function from a maker: the maker runs once a task, its function once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            step = step or fn()
            if batch.num_rows:
                yield step(batch)

    return run


def safe_pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Cut a long text before runs of white space only, into pieces of about `size` characters.

    No pre-token of the supported tokenizers goes on across such a cut. A text without white space stays whole.
    """
    start, end = 0, len(text)
    while end - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def split_bytes(body: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The same for byte strings whose words are separated by single spaces, line ends or tabs."""
    start, end = 0, len(body)
    while end - start > size:
        cut = _GAP.search(body, start + size)
        if cut is None:
            break
        yield body[start : cut.start()]
        start = cut.start()
    yield body[start:]


_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")
