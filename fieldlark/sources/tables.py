"""Sources and sinks: delimited text, Parquet, SQLite and GeoPackage tables, JSON sidecars, slice files."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Rows of a scanned range and of a written chunk.
CHUNK = 50_000


def read(spark: SparkSession, path: str, columns: list[str] | None = None, table: str = "info", sql: str | None = None, encoding: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """A table by its suffix: .csv, .tsv, .parquet, .json, .sqlite or .gpkg; `sql` runs over it as the view `table`.

    Text without an `encoding` is UTF-8, or CP1252 where it isn't valid UTF-8. A `schema` spares the pass that infers one.
    """
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind in ("csv", "tsv"):
        encoding = encoding or text_encoding(spark, path)
        windows = encoding.lower() in ("windows-1252", "cp1252")
        encoding = "ISO-8859-1" if windows else encoding  # Spark's own name of the nearest
        reader = spark.read.option("header", True).option("encoding", encoding).option("sep", "\t" if kind == "tsv" else ",")
        df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
        df = from_latin1(df) if windows else df
    elif kind == "parquet":
        df = spark.read.parquet(path)
    elif kind == "json":
        df = spark.read.option("multiLine", True).json(path)
    elif kind in ("sqlite", "gpkg", "db"):
        spark.dataSource.register(SqliteSource)
        df = spark.read.format("sqlite_table").option("table", table).load(path)
    else:
        raise ValueError(f"no reader for {path}")
    if sql is not None:
        with view(df, table):
            df = spark.sql(sql)
    return df.select(*columns) if columns else df


def text_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8, or windows-1252 if a line doesn't decode: the scan stops at the first one."""
    odd = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1)
    return "windows-1252" if odd.count() else "UTF-8"


def from_latin1(df: DataFrame) -> DataFrame:
    """Text columns that were read as Latin-1, as CP1252: the two differ in the codes 128 to 159."""
    pairs = [(chr(c), x) for c in range(128, 160) if (x := bytes([c]).decode("cp1252", "ignore"))]
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.translate(F.col(f"`{c}`"), *map("".join, zip(*pairs, strict=True))) for c in texts})


@contextmanager
def view(df: DataFrame, name: str) -> Iterator[None]:
    """A temporary view for the statements within; a view of the caller's with that name comes back afterwards."""
    spark = df.sparkSession
    before = spark.table(name) if any(t.name == name and t.isTemporary for t in spark.catalog.listTables()) else None
    df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        spark.catalog.dropTempView(name)
        if before is not None:
            before.createOrReplaceTempView(name)


def write(df: DataFrame, path: str, append: bool = False, table: str = "info") -> None:
    """A table by its suffix; an error if it is there already and `append` isn't given. Text has ten decimals."""
    kind, mode = path.rstrip("/").rpartition(".")[2].lower(), "append" if append else "errorifexists"
    if kind in ("csv", "tsv"):
        text = [F.when(F.col(f"`{f.name}`").isNotNull(), F.format_string("%.10f", F.col(f"`{f.name}`"))).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema]
        df.select(*text).write.mode(mode).option("header", True).option("sep", "\t" if kind == "tsv" else ",").csv(path)
    elif kind == "parquet":
        df.write.mode(mode).parquet(path)
    elif kind == "json":
        df.write.mode(mode).json(path)
    elif kind in ("sqlite", "gpkg", "db"):
        df.sparkSession.dataSource.register(SqliteSource)
        df.coalesce(1).write.format("sqlite_table").option("table", table).option("path", path).option("exists", "append" if append else "error").mode("append").save()
    else:
        raise ValueError(f"no writer for {path}")


def table_info(df: DataFrame) -> dict:
    return table_summary(df).first().asDict()


def copied(spark: SparkSession, source: str, target: str, where: str | None = None) -> None:
    """The rows of a table that fit a condition, written as a table of their own."""
    df = read(spark, source)
    write(df if where is None else df.where(where), target)


def converted(spark: SparkSession, source: str, target: str) -> None:
    """One table from one format to another."""
    write(read(spark, source), target)


def slices(spark: SparkSession, pattern: str, columns: dict) -> DataFrame:
    """All slice files of a pattern, with the metadata that `columns` (a function of the path) takes from their names.

    A slice without data is a file without rows: it simply adds none.
    """
    df = spark.read.parquet(pattern)
    return df.withColumns(columns(F.col("_metadata.file_path")))


def refresh(df: DataFrame, path: str, by: list[str], force: bool = False) -> int:
    """Write the slices that aren't there yet, or all of them anew with `force`; how many were written.

    Slices are directories of a partitioned table; those of other keys stay untouched.
    """
    spark = df.sparkSession
    keys = df.select(*by).distinct()
    if not force:
        try:
            there = spark.read.parquet(path).select(*by).distinct()
        except Exception as e:  # nothing was written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            there = keys.limit(0)
        keys = keys.join(there, by, "left_anti")
    keys = keys.persist()  # what is there changes while slices are written
    try:
        n = keys.count()
        if n:
            rows = df.join(F.broadcast(keys), by, "left_semi") if n <= 100_000 else df.join(keys, by, "left_semi")
            rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*by).parquet(path)
        return n
    finally:
        keys.unpersist()


def table_summary(df: DataFrame) -> DataFrame:
    """One row: how many rows a table has, and its columns in order."""
    return df.agg(F.count("*").alias("rows")).select("rows", F.array(*map(F.lit, df.columns)).alias("columns"))


# The fields of an image's metadata file.
SIDECAR = "imageprofile string, start_date string, end_date string, end_date_incl string, bands array<string>, time_reducer string, roi_bounds array<double>, roi_crs long, path string, base_imageprofile string, weight double"


def sidecars(spark: SparkSession, pattern: str) -> DataFrame:
    """Metadata files of images, one JSON object each, read with a given schema; dates as dates."""
    df = spark.read.option("multiLine", True).schema(SIDECAR).json(pattern)
    return df.withColumns({c: F.to_date(F.substring(c, 1, 10)) for c in ("start_date", "end_date", "end_date_incl")})


_TYPES = {"INT": T.LongType(), "REAL": T.DoubleType(), "FLOA": T.DoubleType(), "DOUB": T.DoubleType(), "BLOB": T.BinaryType()}


class SqliteSource(DataSource):
    """Tables of SQLite and GeoPackage files, scanned by ranges of rowid.

    The file must be on a path that all executors mount.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> T.StructType:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as c:
            info = c.execute(f'PRAGMA table_info("{self.options.get("table", "info")}")').fetchall()
        if not info:
            raise ValueError(f"no table {self.options.get('table', 'info')}")
        return T.StructType([T.StructField(n, _TYPES.get((kind or "").upper()[:4], _TYPES.get((kind or "").upper()[:3], T.StringType()))) for _, n, kind, *_ in info])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SqliteReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _SqliteWriter(self.options, schema, overwrite)


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.names = options["path"], options.get("table", "info"), schema.names

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            low, high = c.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        return [InputPartition((x, min(x + CHUNK - 1, high))) for x in range(low, high + 1, CHUNK)] if low is not None else [InputPartition((0, -1))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        names = ", ".join(f'"{n}"' for n in self.names)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            yield from c.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid BETWEEN ? AND ?', partition.value)


class _SqliteWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.path, self.table, self.schema = options["path"], options.get("table", "info"), schema
        with sqlite3.connect(self.path) as c:
            there = c.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (self.table,)).fetchone()[0]
            if there and options.get("exists") != "append":
                raise ValueError(f"{self.table} is in {self.path} already")
            kinds = {T.LongType: "INTEGER", T.IntegerType: "INTEGER", T.DoubleType: "REAL", T.FloatType: "REAL", T.BinaryType: "BLOB"}
            c.execute(f'CREATE TABLE IF NOT EXISTS "{self.table}" ({", ".join(f"""{chr(34)}{f.name}{chr(34)} {kinds.get(type(f.dataType), "TEXT")}""" for f in schema)})')

    def write(self, rows: Iterator) -> WriterCommitMessage:
        marks, chunk = ", ".join("?" * len(self.schema)), []
        with sqlite3.connect(self.path, timeout=60) as c:
            for row in rows:
                chunk.append(tuple(row))
                if len(chunk) >= CHUNK:
                    c.executemany(f'INSERT INTO "{self.table}" VALUES ({marks})', chunk)
                    chunk = []
            c.executemany(f'INSERT INTO "{self.table}" VALUES ({marks})', chunk)
        return WriterCommitMessage()
