"""Property tables, uploads, templates, embedded databases and files as DataFrames."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from alloyframe.schema import CSV_NULLS, FILE_CLASSES, PROPERTY_FACT


def nulls_as_csv(df: DataFrame) -> DataFrame:
    """Text columns with the strings that a CSV reader takes for null as null."""
    return df.select([F.when(~F.col(f"`{f.name}`").isin(*CSV_NULLS), F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_properties_csv(spark: SparkSession, path: str, material_class: str | None = None) -> DataFrame:
    """A property file, all columns as text. Columns are named by the header; `_ord` is the order of the rows.

    Order is by file and place within it, made dense only by those who need it.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).option("multiLine", False).option("escape", '"').csv(path)
    out = nulls_as_csv(raw).withColumn("_src", F.lit("csv")).withColumn("_ord", F.monotonically_increasing_id())
    return out if material_class is None else out.withColumn("material_class", F.lit(material_class))


def read_class(spark: SparkSession, folder: str, label: str) -> DataFrame:
    """The property file of a label (Composites, Polymers or Fibers) in a folder, with its class."""
    return read_properties_csv(spark, f"{folder}/{label}.csv", FILE_CLASSES[label])


def read_uploads(spark: SparkSession, path: str) -> DataFrame:
    """The store of uploaded rows; without a store, no rows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], PROPERTY_FACT)
    return spark.read.schema(PROPERTY_FACT).parquet(path)


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of files such as PDF documents and images."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def data_url(content, kind: str = "image/png"):
    """Content as a URL that holds it."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """A template sheet as CSV or Parquet, with `_ord` as the order of its rows."""
    if path.endswith(".parquet"):
        out = spark.read.parquet(path)
    else:
        out = spark.read.option("header", True).csv(path)
    return out.withColumn("_ord", F.monotonically_increasing_id())


def template_columns(columns: Sequence[str]) -> tuple[str | None, str]:
    """The first column that speaks of sections, if any, and the first that speaks of properties, else the first."""
    section = next((c for c in columns if "section" in c.lower()), None)
    return section, next((c for c in columns if "property" in c.lower()), columns[0])


def material_tables(spark: SparkSession, like: str = "*") -> list[str]:
    """Names of the catalog's tables, without those of an embedded database itself."""
    return [t.name for t in spark.catalog.listTables(pattern=like) if not t.name.startswith("sqlite_")]


class _Table(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)


class SqliteSource(DataSource):
    """An embedded database file: every table's rows with the table's name, a partition for each table.

    Options: path, and columns as a comma-separated list; a table that lacks a column gives null for it.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite_tables"

    def schema(self) -> str:
        columns = self.options.get("columns", "section,property_name,value,unit,english,comments").split(",")
        return ", ".join(["material_table string", "_ord long", *(f"`{c}` string" for c in columns)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SqliteReader(self.options["path"], schema.names[2:])


class _SqliteReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            names = [r[0] for r in db.execute(r"SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite\_%' ESCAPE '\' ORDER BY name")]
        return [_Table(n) for n in names]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        quote = lambda x: '"' + x.replace('"', '""') + '"'
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            there = {r[1] for r in db.execute(f"PRAGMA table_info({quote(partition.value)})")}
            cols = ", ".join(f"CAST({quote(c)} AS TEXT)" if c in there else "NULL" for c in self.columns)
            for i, row in enumerate(db.execute(f"SELECT {cols} FROM {quote(partition.value)}")):
                yield (partition.value, i, *row)


def read_sqlite(spark: SparkSession, path: str, columns: Sequence[str] = ("section", "property_name", "value", "unit", "english", "comments")) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_tables").option("columns", ",".join(columns)).load(path)
