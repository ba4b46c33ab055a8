"""Reproducible grouped training data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import uniform


def synth_groups(keys: DataFrame, key: str, groups: int = 10, seed: int = 42) -> DataFrame:
    """One record per key: group ``key % groups``, three uniform features on [0,1), [0,2), [0,3) and
    their sum plus uniform noise as the label.

    Pass ``spark.range(n).toDF(key)`` for n records, or the keys of any table.
    """
    return (
        keys.select(F.col(key).cast("bigint").alias("record_id"))
        .withColumn("group_id", F.pmod("record_id", F.lit(groups)))
        .withColumns({f"feature_{i}": uniform("record_id", f"{seed}-f{i}") * float(i) for i in (1, 2, 3)})
        .withColumn(
            "label",
            F.col("feature_1") + F.col("feature_2") + F.col("feature_3") + uniform("record_id", f"{seed}-noise"),
        )
    )
