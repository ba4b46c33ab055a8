"""Batch sources.  Each returns a lazy DataFrame; nothing is read beyond what Spark needs for a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType



def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines.  Without a schema Spark scans the input once more to infer it."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def query_path(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """Query files by path from SQL text."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_external(spark: SparkSession, fmt: str, **options) -> DataFrame:
    """Any registered data source by format name, e.g. a warehouse connector put on the class path."""
    return spark.read.format(fmt).options(**options).load()


def from_rows(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def from_pandas(spark: SparkSession, pdf, schema: StructType | str | None = None) -> DataFrame:
    return spark.createDataFrame(pdf, schema) if schema is not None else spark.createDataFrame(pdf)


def html_text(html: Column | str) -> Column:
    """Visible text of an HTML string: scripts, styles, comments and tags removed, the common
    entities decoded, white space collapsed."""
    col = F.col(html) if isinstance(html, str) else html
    for pattern, to in HTML_RULES:
        col = F.regexp_replace(col, pattern, to)
    return F.trim(col)


# Applied in order; the syntax is common to Java and RE2 so that an oracle can use the same list.
HTML_RULES = [
    (r"(?is)<script[^>]*>.*?</script>", " "),
    (r"(?is)<style[^>]*>.*?</style>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?s)<[^>]*>", " "),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&amp;", "&"),
    (r"[ \t\r\n]+", " "),
]


def load_documents(pages: DataFrame, doc_id: str, html: str) -> DataFrame:
    """Paged documents as ``(doc_id, text)``; one projection, pages without visible text dropped."""
    return pages.select(F.col(doc_id).alias("doc_id"), html_text(html).alias("text")).filter(
        F.col("text") != ""
    )
