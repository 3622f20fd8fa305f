"""Surrogate keys and row hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The key format must equal that of keys already stored.
SEPARATOR = "||"
NULL_MARK = "_null_"


def surrogate_key(*parts: Column) -> Column:
    """md5 over the text of the parts, with a mark in place of each NULL."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_MARK)) for part in parts]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


def row_hash(df: DataFrame) -> Column:
    """A number to spread rows by, the same when a lost task is run again.

    The input partition takes part, so that copies of one row spread as well.
    """
    hashable = [F.col(name) for name, kind in df.dtypes if "map<" not in kind]
    return F.xxhash64(*hashable, F.spark_partition_id())
