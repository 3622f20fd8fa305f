"""Row-level changes between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.keys import row_hash
from headway.operators.ranking import same

COPIES_PER_TASK = 100_000


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ, tagged insert, delete, update_preimage or update_postimage.

    Equal rows cancel out in a map-side combined count, so repeated keys cause
    no products of rows and a row present several times is counted as such. A
    key with rows leaving and rows arriving is an update.
    """
    columns = new.columns
    tagged = old.select(*columns, F.lit(-1).alias("_sign")).unionByName(
        new.select(*columns, F.lit(1).alias("_sign"))
    )
    net = (
        tagged.groupBy(*columns)
        .agg(F.sum("_sign").alias("_net"))
        .filter(F.col("_net") != 0)
    )
    sides = net.groupBy(*keys).agg(
        (F.min("_net") < 0).alias("_left"), (F.max("_net") > 0).alias("_came")
    )
    both = net.alias("n").join(sides.alias("k"), same("n", "k", keys))
    updated = F.col("k._left") & F.col("k._came")
    gone = F.col("n._net") < 0
    kind = (
        F.when(updated & gone, "update_preimage")
        .when(updated, "update_postimage")
        .when(gone, "delete")
        .otherwise("insert")
    )
    changed = both.select(
        *[F.col(f"n.{name}") for name in columns],
        kind.alias("_change_type"),
        F.abs("n._net").alias("_copies"),
    )
    return _repeated(changed)


def _repeated(changed: DataFrame) -> DataFrame:
    """Each row as often as ``_copies`` says; many copies of a row come from many tasks.

    A row is cut into chunks of copies, which are dealt out by the row and the number of
    the chunk before they are repeated.
    """
    chunks = F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES_PER_TASK))
    left = F.col("_copies") - F.col("_chunk") * COPIES_PER_TASK
    dealt = changed.withColumn("_chunk", F.explode(chunks))
    dealt = dealt.withColumn("_row", row_hash(changed)).repartition("_row", "_chunk")
    copies = F.least(left, F.lit(COPIES_PER_TASK)).cast("int")
    one_each = F.explode(F.sequence(F.lit(1), copies))
    return dealt.withColumn("_copy", one_each).drop("_copy", "_copies", "_chunk", "_row")
