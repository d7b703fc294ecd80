"""CSV and Parquet readers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from rowsmith.functions import checks

FORMATS = (".csv", ".parquet")

Schema = StructType | str | None


MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")


def read_csv(spark: SparkSession, path: str, schema: Schema = None, mode: str = "FAILFAST") -> DataFrame:
    """Read CSV by the names in its header.

    A schema gives columns and types, in any order; names that the header lacks are an error. Without a
    schema the types are inferred, which reads the file twice. Rows that don't fit the types fail the
    job; with mode ``PERMISSIVE`` what doesn't fit is null, with ``DROPMALFORMED`` such rows go.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(MODES)}")
    reader = spark.read.option("header", True).option("mode", mode)
    if not schema:
        return _found(lambda: reader.option("inferSchema", True).csv(path), path)
    wanted = schema if isinstance(schema, StructType) else _parsed(schema)
    header = _found(lambda: spark.read.option("header", True).csv(path), path)
    checks.require_columns(header, wanted.fieldNames())
    fold = checks.folding(header)
    types = {fold(f.name): f for f in wanted.fields}
    full = StructType([types.get(fold(c), StructField(c, StringType())) for c in header.columns])
    found = _found(lambda: reader.schema(full).option("enforceSchema", False).csv(path), path)
    return found.select(*wanted.fieldNames())


def _parsed(schema: str) -> StructType:
    return StructType.fromDDL(schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _found(lambda: spark.read.parquet(path), path)


def read_table(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    """Read one table with the reader its suffix names."""
    checks.require_suffix(path, FORMATS)
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema)
    return read_parquet(spark, path)


def read_tables(
    spark: SparkSession,
    paths: Sequence[str],
    schemas: Sequence[Schema] | None = None,
    missing: str = "error",
) -> list[DataFrame]:
    """Read several tables, each by its own suffix; ``missing`` ones are an ``error`` or ``skip``-ped."""
    if missing not in ("error", "skip"):
        raise ValueError(f"missing must be error or skip, got {missing!r}")
    schemas = schemas or [None] * len(paths)
    checks.require_same_length(paths=paths, schemas=schemas)
    tables = []
    for path, schema in zip(paths, schemas):
        try:
            tables.append(read_table(spark, path, schema))
        except FileNotFoundError:
            if missing == "error":
                raise
    return tables


def _found(read: Callable[[], DataFrame], path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such table: {path}") from e
        raise


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """File name, number and rows of each row group of a Parquet table, from the files' footers alone."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(conf).listFiles(folder, True)
    found = []
    while listed.hasNext():
        file = listed.next().getPath()
        if not file.getName().endswith(".parquet"):
            continue
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            found += [(file.getName(), i, g.getRowCount()) for i, g in enumerate(reader.getRowGroups())]
        finally:
            reader.close()
    return spark.createDataFrame(found, "file string, row_group int, rows bigint")
