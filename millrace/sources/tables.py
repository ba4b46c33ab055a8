"""Named parquet tables in the session's catalog, written by Spark's own writers.

A ``Tables`` is a database of the catalog whose tables lie below one root folder.  Overwriting writes the rows into a new table
first and then gives it the name, so a table may be computed from itself, rows that break an expectation never show, and a
failed write leaves the table as it was.  Appends insert; merges and partition replacements use Spark's dynamic partition
overwrite, which stages the new files of the partitions concerned and swaps them when the job is done.

A table may be bucketed and sorted by its key: merges into it and differences between it and its clones then move no row of
the table.  One writer per table at a time.  Folders of replaced tables stay, for readers that still use them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.quality import ExpectationError, expect, violations
from millrace.session import shared_dir


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = "t" + hashlib.md5(self.root.encode()).hexdigest()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")

    def full(self, name: str) -> str:
        """The table's name in the catalog, for SQL."""
        return f"`{self.database}`.`{name}`"

    # -- reads -------------------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{name}")

    def read(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise LookupError(f"no table {name!r} below {self.root}")
        return self.spark.table(self.full(name))

    def comment(self, name: str) -> str | None:
        return self.spark.catalog.getTable(f"{self.database}.{name}").description

    def property(self, name: str, key: str):
        """A property kept with the table, None if it has none."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.full(name)}").filter(F.col("key") == key).first()
        return json.loads(found["value"]) if found else None

    def keys(self, name: str) -> list[str]:
        return self.property(name, "keys") or []

    def violations(self, name: str) -> dict[str, int]:
        """Counts of the watched expectations when the table was written."""
        return self.property(name, "violations") or {}

    def _columns(self, name: str) -> list:
        return self.spark.catalog.listColumns(f"{self.database}.{name}")

    def partition_by(self, name: str) -> list[str]:
        return [c.name for c in self._columns(name) if c.isPartition]

    def bucket_by(self, name: str) -> tuple[int, str] | None:
        rows = {r[0]: r[1] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full(name)}").collect()}
        return (int(rows["Num Buckets"]), rows["Bucket Columns"].strip("[]`")) if "Num Buckets" in rows else None

    # -- writes ------------------------------------------------------------------------------------

    def _set(self, table: str, **properties) -> None:
        for key, value in properties.items():
            text = json.dumps(value).replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{text}')")

    def overwrite(
        self,
        name: str,
        df: DataFrame,
        comment: str | None = None,
        keys: Iterable[str] = (),
        partition_by: Iterable[str] = (),
        bucket_by: tuple[int, str] | None = None,
        expects: Mapping[str, str] | None = None,
        watch: Mapping[str, str] | None = None,
        check: Callable[[DataFrame], None] | None = None,
    ) -> None:
        """Replace rows and schema.

        Violations of ``expects`` raise before the rows show, those of ``watch`` are counted and kept with the table; both are
        counted while writing.  ``check`` may look at the written rows and raise, too."""
        partition_by = list(partition_by)
        new = f"{name}_{uuid.uuid4().hex}"
        rules = {**(expects or {}), **(watch or {})}
        if rules:
            df, obs = expect(df, rules)
        if bucket_by:
            df = df.repartition(*bucket_by)  # a bucket is one file per partition
        elif partition_by:
            # few files per partition value; adaptive execution splits a value that holds much of the rows
            df = df.hint("rebalance", *partition_by)
        writer = df.write.format("parquet").option("path", f"{self.root}/{new}")
        if partition_by:
            # kept with the table: overwriting inserts replace the partitions they bring, no others
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        if bucket_by:
            writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
        writer.saveAsTable(self.full(new))
        try:
            counts = violations(obs, rules) if rules else {}
            if bad := {n: counts[n] for n in expects or {} if counts[n]}:
                raise ExpectationError(bad)
            if check is not None:
                check(self.read(new))
        except Exception:
            self.spark.sql(f"DROP TABLE {self.full(new)}")
            raise
        self._set(self.full(new), keys=list(keys), violations={n: counts[n] for n in watch or {}})
        if comment is not None:
            text = comment.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"COMMENT ON TABLE {self.full(new)} IS '{text}'")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full(name)}")
        self.spark.sql(f"ALTER TABLE {self.full(new)} RENAME TO {self.full(name)}")

    def append(self, name: str, df: DataFrame, merge_schema: bool = True, expects: Mapping[str, str] | None = None) -> None:
        """Add rows, columns matched by name.  With ``merge_schema`` either side may lack columns of the other."""
        if not self.exists(name):
            return self.overwrite(name, df, expects=expects)
        old = self.read(name).schema
        new = [f for f in df.schema.fields if f.name not in old.names]
        lacking = [n for n in old.names if n not in df.columns]
        if not merge_schema and (new or lacking):
            raise ValueError(f"schema differs: new {[f.name for f in new]}, missing {lacking}")
        if expects:  # rows that break a rule must not show: they are counted in a stored copy
            watched, obs = expect(df, expects)
            path = shared_dir(self.spark, "append")
            watched.write.parquet(path)
            if bad := {n: c for n, c in violations(obs, expects).items() if c}:
                raise ExpectationError(bad)
            df = self.spark.read.schema(df.schema).parquet(path)
        if new:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.full(name)} ADD COLUMNS ({added})")
        self._insert(name, df)

    def _insert(self, name: str, df: DataFrame, overwrite: bool = False) -> None:
        """Insert by name; with ``overwrite`` the partitions that occur in ``df`` are replaced."""
        target = self.read(name).schema
        cols = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
        df.select(*cols).write.insertInto(self.full(name), overwrite=overwrite)

    def replace_partitions(self, name: str, df: DataFrame, partitions: list[list[str]]) -> None:
        """Swap the rows of the listed partition values for ``df``; other partitions are not read."""
        parts = self.partition_by(name)
        if not parts:
            raise ValueError(f"table {name!r} is not partitioned")
        path = shared_dir(self.spark, "partitions")
        df.write.parquet(path)
        df = self.spark.read.schema(df.schema).parquet(path)
        self._insert(name, df.hint("rebalance", *parts), overwrite=True)
        # one row per partition listed: those that have no rows any more
        wanted = {tuple(_text(v) for v in r) for r in df.select(*parts).distinct().collect()}
        for r in self.read(name).filter(_any_of(parts, partitions)).select(*parts).distinct().collect():
            if tuple(_text(v) for v in r) not in wanted:
                spec = ", ".join(f"`{c}` = " + ("NULL" if v is None else f"'{v}'") for c, v in zip(parts, r))
                self.spark.sql(f"ALTER TABLE {self.full(name)} DROP PARTITION ({spec})")

    def ctas(self, name: str, sql: str, **kw) -> None:
        """CREATE OR REPLACE TABLE name AS <sql>."""
        self.overwrite(name, self.spark.sql(sql), **kw)

    def clone(self, path: str, name: str, fmt: str = "parquet") -> None:
        """Copy the rows and schema of a file table into a named table and compare row counts."""
        self._copied(self.spark.read.format(fmt).load(path), name, comment=f"clone of {path}")

    def snapshot(self, name: str, as_: str) -> None:
        """Copy a table as it is now under another name, laid out in the same way."""
        layout = {"keys": self.keys(name), "partition_by": self.partition_by(name), "bucket_by": self.bucket_by(name)}
        self._copied(self.read(name), as_, comment=self.comment(name), **layout)

    def _copied(self, source: DataFrame, name: str, **layout) -> None:
        self.overwrite(name, source, **layout)
        want, got = source.count(), self.read(name).count()
        if want != got:
            raise RuntimeError(f"copy {name!r} has {got} of {want} rows")

    def merge_update(self, name: str, src: DataFrame, on: str, set_: Iterable[str]) -> None:
        """MERGE ... WHEN MATCHED THEN UPDATE SET: columns ``set_`` of rows whose key occurs in ``src``.

        NULL keys match nothing and a key that occurs twice in ``src`` is an error.  The source is computed once and stored.
        Only the partitions of the table that hold a matching key are rewritten; no row of a table bucketed by the key moves.
        """
        set_ = list(set_)
        path = shared_dir(self.spark, "merge-source")
        src = src.select(on, *set_).filter(F.col(on).isNotNull())
        src.write.parquet(path)
        src = self.spark.read.schema(src.schema).parquet(path)
        twice = src.groupBy(on).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"merge source has key {on}={twice[0][0]!r} more than once")
        target, parts = self.read(name), self.partition_by(name)
        if parts:
            hit = target.select(on, *parts).join(src.select(on), on, "left_semi")
            # one row per partition of the table, never per record
            touched = [[_text(v) for v in r] for r in hit.select(*parts).distinct().collect()]
            if not touched:
                return
            target = target.filter(_any_of(parts, touched))
        updates = src.select(F.col(on).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in set_], F.lit(True).alias("_hit"))
        merged = (
            target.join(updates, target[on] == updates["_key"], "left")
            .withColumns({c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in set_})
            .select(*target.columns)
        )
        if parts:
            return self._insert(name, merged if self.bucket_by(name) else merged.hint("rebalance", *parts), overwrite=True)
        self.overwrite(name, merged, comment=self.comment(name), keys=self.keys(name), bucket_by=self.bucket_by(name))

    def changes(self, before: str, after: str, keys: Iterable[str]) -> DataFrame:
        """Change feed from one snapshot to another: ``insert``, ``delete`` and the pre and post image of every updated row."""
        return diff(self.read(before), self.read(after), list(keys))


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed difference of two frames: a full outer join on the key.

    A key may be repeated.  Rows that agree in all columns are then the same row, as often as both sides have them; what is
    left of a key is paired in the order of its columns, and a row without a partner is an insert or a delete."""
    cols = list(new.columns) + [c for c in old.columns if c not in new.columns]
    rest = [c for c in cols if c not in keys]

    if any(_repeats(df, keys) for df in (old, new)):
        here = set(old.columns), set(new.columns)
        old = old.select(*[F.col(c) if c in here[0] else F.lit(None).cast(new.schema[c].dataType).alias(c) for c in cols])
        new = new.select(*[F.col(c) if c in here[1] else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in cols])
        numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*(rest or keys)))
        old, new = old.exceptAll(new).withColumn("_nth", numbered), new.exceptAll(old).withColumn("_nth", numbered)
        return _paired(old, new, [*keys, "_nth"], rest).drop("_nth")
    return _paired(old, new, keys, rest)


def _paired(old: DataFrame, new: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    """``diff`` by unique keys."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        have = set(df.columns)
        other = new if tag == "o" else old
        values = [
            (F.col(c) if c in have else F.lit(None).cast(other.schema[c].dataType)).alias(c) for c in rest
        ]
        return df.select(*[F.col(k).alias(f"{tag}_{k}") for k in keys], F.struct(F.lit(1).alias("_in"), *values).alias(tag))

    o, n = side(old, "o"), side(new, "n")
    cond = None
    for k in keys:
        eq = F.col(f"o_{k}") == F.col(f"n_{k}")
        cond = eq if cond is None else cond & eq
    joined = o.join(n, cond, "full_outer")

    def image(tag: str, change: str) -> Column:
        return F.struct(
            *[F.col(f"{tag}_{k}").alias(k) for k in keys],
            *[F.col(f"{tag}.{c}").alias(c) for c in rest],
            F.lit(change).alias("_change"),
        )

    images = (
        F.when(F.col("o").isNull(), F.array(image("n", "insert")))
        .when(F.col("n").isNull(), F.array(image("o", "delete")))
        .when(~F.col("o").eqNullSafe(F.col("n")), F.array(image("o", "update_preimage"), image("n", "update_postimage")))
    )
    return joined.select(F.inline(images))


def _repeats(df: DataFrame, keys: list[str]) -> bool:
    """Whether a key is repeated; keys with a NULL are equal to none."""
    return not df.dropna(subset=keys).groupBy(*keys).count().filter("count > 1").isEmpty()


class Features:
    """Feature tables: parquet tables with a declared primary key, checked on every write."""

    def __init__(self, tables: Tables):
        self.tables = tables

    def write(self, name: str, df: DataFrame, keys: Iterable[str], comment: str | None = None) -> None:
        """Create or replace the table; the key is checked on the written rows, which are computed once."""
        keys = list(keys)

        def unique(written: DataFrame) -> None:
            no_key = F.lit(False)
            for k in keys:
                no_key = no_key | F.col(k).isNull()
            bad = written.groupBy(*keys).count().filter((F.col("count") > 1) | no_key).limit(1).collect()
            if bad:
                raise ValueError(f"key {keys} of {name!r} is not unique and non-null, e.g. {bad[0].asDict()}")

        self.tables.overwrite(name, df, comment=comment, keys=keys, check=unique)

    def read(self, name: str) -> DataFrame:
        return self.tables.read(name)

    def keys(self, name: str) -> list[str]:
        return self.tables.keys(name)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def append_frames(old: DataFrame, new: DataFrame) -> DataFrame:
    """Row union by column name; a column one side lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def _text(value):
    return None if value is None else str(value)


def _any_of(cols: list[str], values: list[list[str]]) -> Column:
    """TRUE when the partition columns hold one of the listed values, otherwise FALSE."""
    if len(cols) == 1:
        listed = F.col(cols[0]).cast("string").isin([v[0] for v in values if v[0] is not None])
        if any(v[0] is None for v in values):
            listed = listed | F.col(cols[0]).isNull()
        return F.coalesce(listed, F.lit(False))
    hit = F.lit(False)
    for v in values:
        row = F.lit(True)
        for c, x in zip(cols, v):
            row = row & F.col(c).cast("string").eqNullSafe(F.lit(x))
        hit = hit | row
    return hit
