"""Training runs and model names as tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash32
from millrace.operators.topk import best_per, latest_version, top_n
from millrace.sources.tables import Tables

RUN_SCHEMA = (
    "run_id string, parent_run_id string, experiment string, params map<string,string>, "
    "metrics map<string,double>, tags map<string,string>, end_time timestamp"
)


class RunLog:
    """Append-only run table.  Jobs return run rows and append them in one write; nothing calls a
    service from inside a task."""

    def __init__(self, tables: Tables, name: str = "runs"):
        self.tables, self.name = tables, name

    def append(self, rows: DataFrame) -> None:
        return self.tables.append(self.name, rows)

    def read(self) -> DataFrame:
        return self.tables.read(self.name)

    def search(self, cond: Column | str | None = None, order_by: Iterable[Column] = (), n: int | None = None) -> DataFrame:
        df = self.read()
        if cond is not None:
            df = df.filter(cond)
        order_by = list(order_by)
        if n is not None:
            return top_n(df, order_by, n, tie=["run_id"])
        return df.orderBy(*order_by) if order_by else df

    def best_per_family(self, metric: str, ascending: bool = True, family: str = "regressor") -> DataFrame:
        df = self.read().select(
            "*", F.col("params")[family].alias("family"), F.col("metrics")[metric].alias("score")
        )
        return best_per(df, "family", "score", ascending, tie="run_id")


class Models:
    """Versions of named models and the aliases that point at them."""

    def __init__(self, tables: Tables):
        self.tables = tables

    def register(self, rows: DataFrame) -> None:
        """Append version rows ``(name, version int, uri, run_id)``."""
        return self.tables.append("model_versions", rows)

    def versions(self) -> DataFrame:
        return self.tables.read("model_versions")

    def latest(self) -> DataFrame:
        return latest_version(self.versions())

    def set_alias(self, name: str, alias: str, version: int) -> None:
        spark = self.tables.spark
        row = spark.createDataFrame([(name, alias, version)], "name string, alias string, version int")
        if not self.tables.exists("model_aliases"):
            return self.tables.overwrite("model_aliases", row)
        rest = self.tables.read("model_aliases").filter(~((F.col("name") == name) & (F.col("alias") == alias)))
        return self.tables.overwrite("model_aliases", rest.unionByName(row).coalesce(1))

    def delete_alias(self, name: str, alias: str) -> None:
        rest = self.tables.read("model_aliases").filter(~((F.col("name") == name) & (F.col("alias") == alias)))
        return self.tables.overwrite("model_aliases", rest.coalesce(1))

    def aliases(self) -> DataFrame:
        return self.tables.read("model_aliases")

    def resolved(self) -> DataFrame:
        """Every alias with the version row it points at."""
        return self.aliases().join(self.versions(), ["name", "version"])

    def resolve(self, name: str, alias: str):
        """Version row behind ``name@alias``, or LookupError."""
        rows = self.resolved().filter((F.col("name") == name) & (F.col("alias") == alias)).limit(1).collect()
        if not rows:
            raise LookupError(f"no model {name}@{alias}")
        return rows[0]


def dataset_digest(df: DataFrame, name: str) -> DataFrame:
    """Name, row count, schema text and an order-free content digest of a dataset, as one row.

    The digest is the sum of 32 bits of every row's md5, its columns in order as text, so that any SQL engine can repeat it.
    """
    row = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        # decimals cannot overflow on the sum and, unlike XOR, repeated rows do not cancel out
        F.coalesce(F.sum(hash32(row, "row").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"),
    ).select(F.lit(name).alias("dataset"), F.lit(df.schema.simpleString()).alias("schema"), "n_rows", "digest")


def dataset_tags() -> Column:
    """The ``tags`` that record a dataset with a run, over its digest row."""
    return F.create_map(*[x for c in ("dataset", "schema", "digest") for x in (F.lit(c), F.col(c))])
