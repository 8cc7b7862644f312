"""Order within a key, without putting a whole key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: list[str], order: list[str], bucket: Column, carry: list[str], prefix: str = "prev_") -> DataFrame:
    """Add the previous row's ``carry`` columns, in ``order`` within ``keys``.

    A plain ``lag`` over ``keys`` would sort a hot key (one session with a third of all rows) in one
    task. Here rows are spread by ``keys`` + ``bucket``, a coarse, monotone function of the order
    columns. ``lag`` runs inside a bucket, and only the last row of each bucket (picked by a partial
    aggregate before any shuffle) goes through a second, far smaller pass to the next bucket.
    """
    names = [*keys, "_bucket"]
    spread = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*names).orderBy(*order)
    payload = F.struct(*carry)
    ranked = spread.withColumn("_lag", F.lag(payload).over(inside))

    last = spread.groupBy(*names).agg(F.max_by(payload, F.struct(*order)).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    handed = last.select(*names, F.lag("_last").over(across).alias("_handed"))

    joined = ranked.join(handed, names, "left").withColumn("_p", F.coalesce("_lag", "_handed"))
    return joined.select(*df.columns, *[F.col(f"_p.{c}").alias(f"{prefix}{c}") for c in carry])


def with_position(df: DataFrame, keys: list[str], order: list[str], bucket: Column, into: str = "position") -> DataFrame:
    """Add each row's position (from 0) in ``order`` within ``keys``.

    Rows are numbered inside ``keys`` + ``bucket``, a coarse, monotone function of the order columns;
    the rows of earlier buckets are added from per-bucket counts.
    """
    names = [*keys, "_bucket"]
    spread = df.withColumn("_bucket", bucket)
    sizes = spread.groupBy(*names).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*names, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*names).orderBy(*order)
    numbered = spread.withColumn("_no", F.row_number().over(inside) - 1)
    return numbered.join(offsets, names, "inner").select(*df.columns, (F.col("_no") + F.col("_before")).alias(into))
