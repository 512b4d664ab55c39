"""Whole-record comparison of filing sets.

Records are equal when all their columns are, null equal to null. That is how grouping compares, so the
differences below are groupings: both sides are pre-aggregated before the one shuffle, and a record that
makes up a third of the rows is a single row per task by then. Counts are turned back into rows last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_LENGTH = 10_000


def repeat_rows(df: DataFrame, copies: str = "copies", run: int = RUN_LENGTH) -> DataFrame:
    """Every row as often as its ``copies`` column says; that column is dropped.

    Rows with many copies are first cut into runs of at most ``run`` copies, which are spread over the
    cluster before they are written out, so that no task multiplies one row on its own. The number of
    partitions is given, as adaptive execution would otherwise merge these few, short rows again.
    """
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = F.col(copies)
    few = df.filter(count <= run)
    columns = [name for name in df.columns if name != copies]
    runs = (
        df.filter(count > run)
        .withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / run))))
        .withColumn(copies, F.least(F.lit(run).cast("long"), count - F.col("_run") * run))
        .repartition(spread, "_run", *columns)
        .drop("_run")
    )
    return (
        few.unionByName(runs)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), count)))
        .select(*columns)
    )


def fresh_records(new: DataFrame, seen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that equal no row of ``seen``, every copy of them kept."""
    both = new.select(*columns, F.lit(True).alias("_new")).unionByName(
        seen.select(*columns, F.lit(False).alias("_new"))
    )
    counted = both.groupBy(*columns).agg(
        F.count_if("_new").alias("copies"), F.bool_and("_new").alias("unseen")
    )
    return repeat_rows(counted.filter("unseen").drop("unseen"))


def fresh_across_snapshots(
    new: DataFrame, seen: DataFrame, columns: Sequence[str], snapshot: str = "snapshot_id"
) -> DataFrame:
    """The same, when ``new`` holds several snapshots that overlap each other.

    A record counts as found by the earliest snapshot that holds it, with the copies it has there; later
    snapshots repeat it. A snapshot whose rows are spread over two batches is still one snapshot: its
    own rows in ``seen`` do not make the rest of it seen.
    """
    # only state that may equal a record of the batch takes part in the grouping
    hashed = F.xxhash64(*columns)
    wanted = new.select(hashed.alias("_hash")).distinct()
    met = seen.withColumn("_hash", hashed).join(wanted, "_hash", "left_semi")
    both = new.select(*columns, snapshot, F.lit(True).alias("_new")).unionByName(
        met.select(*columns, snapshot, F.lit(False).alias("_new"))
    )
    per_snapshot = both.groupBy(*columns, snapshot).agg(
        F.count_if("_new").alias("found"), F.count_if(~F.col("_new")).alias("known")
    )
    found_in = F.when(F.col("found") > 0, F.col(snapshot))
    known_in = F.when(F.col("known") > 0, F.col(snapshot))
    per_record = per_snapshot.groupBy(*columns).agg(
        F.min(found_in).alias(snapshot),
        F.min_by("found", found_in).alias("copies"),
        F.min(known_in).alias("first_known"),
        F.max(known_in).alias("last_known"),
    )
    unseen = F.col("first_known").isNull() | (
        (F.col("first_known") == F.col(snapshot)) & (F.col("last_known") == F.col(snapshot))
    )
    fresh = per_record.filter(F.col(snapshot).isNotNull() & unseen)
    return repeat_rows(fresh.select(*columns, snapshot, "copies"))


def state_after(seen: DataFrame, fresh: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Everything seen once the fresh records are added."""
    return seen.select(*columns).unionByName(fresh.select(*columns))
