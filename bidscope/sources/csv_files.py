"""Folders of CSV tables: ``<folder>/<table>.csv``, a file or a folder of part files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.columns import quoted
from bidscope.schemas import RAW_TABLES


# Wide enough for any 64-bit number, with room for the zeros behind its point.
_WHOLE = T.DecimalType(38, 9)


def _typed(field: T.StructField) -> Column:
    column = F.col(quoted(field.name))
    if not isinstance(field.dataType, T.IntegralType):
        return column
    fraction = F.raise_error(F.concat(F.lit(f"{field.name} is no whole number: "), column.cast("string")))
    whole = F.when(column.isNull() | (column == F.floor(column)), column).otherwise(fraction.cast(_WHOLE))
    return whole.cast(field.dataType).alias(field.name)


def read_csv(
    spark: SparkSession,
    folder: str,
    table: str,
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A table with a header line.

    Columns are matched by name with ``schema``, or with the known schema of the table; columns
    it does not name are strings. Types are inferred, at the price of another pass, only for a
    table that has no schema.

    Nothing is changed in silence: a cell that does not parse, a short row, a part file with another
    header and a fraction in a column of whole numbers each end the read that meets them with an
    error. ``3.0`` is a whole number. ``options`` are those of Spark's reader and come last.
    """
    path = f"{folder.rstrip('/')}/{table}.csv"
    reader = spark.read.option("header", True).options(**{"enforceSchema": "false", "mode": "FAILFAST"} | options)
    known = schema or RAW_TABLES.get(table)
    try:
        if known is None:
            return reader.option("inferSchema", True).csv(path)
        header = reader.csv(path).columns
        types = {field.name: field.dataType for field in known.fields}
        by_name = [T.StructField(name, types.get(name, T.StringType()), True) for name in header]
        read_as = [T.StructField(f.name, _WHOLE if isinstance(f.dataType, T.IntegralType) else f.dataType) for f in by_name]
        return reader.schema(T.StructType(read_as)).csv(path).select(*[_typed(field) for field in by_name])
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"The table {table} has no file or folder {path}") from error
        raise


#: Column of ``read_csv_rescued``: what could not be read of a row, a text per cell or one for the whole line.
RESCUED = "_rescued"
_LINE = "_line"


def read_csv_rescued(
    spark: SparkSession, folder: str, table: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """A table of which every line is a row, with ``_rescued``: empty where the whole line was read.

    A cell that does not parse is null and ``column=text`` is rescued; of a line with too few or too many cells all columns
    that could be read are kept and ``line=text`` is rescued. A part file with another header is still an error, as its
    cells would be mistaken for others.
    """
    path = f"{folder.rstrip('/')}/{table}.csv"
    known = schema or RAW_TABLES.get(table)
    if known is None:
        raise ValueError(f"The table {table} has no schema to read it by.")
    reader = spark.read.option("header", True).options(**{"enforceSchema": "false"} | options)
    try:
        header = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"The table {table} has no file or folder {path}") from error
        raise
    texts = T.StructType([T.StructField(name, T.StringType()) for name in [*header, _LINE]])
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).schema(texts).csv(path)
    types = {field.name: field.dataType for field in known.fields}
    typed, lost = [], [F.when(F.col(_LINE).isNotNull(), F.concat(F.lit("line="), _LINE))]
    for name in header:
        text, kind = F.col(quoted(name)), types.get(name, T.StringType())
        value = _parsed(text, kind)
        typed.append(value.alias(name))
        lost.append(F.when(text.isNotNull() & value.isNull(), F.concat(F.lit(f"{name}="), text)))
    return rows.select(*typed, F.array_compact(F.array(*lost)).alias(RESCUED))


def _parsed(text: Column, kind: T.DataType) -> Column:
    """A cell as the type, or null; ``3.0`` is a whole number and ``3.5`` is not."""
    if not isinstance(kind, T.IntegralType):
        return text.try_cast(kind)
    number = text.try_cast(_WHOLE)
    return F.when(number == F.floor(number), number.try_cast(kind))


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Names of the CSV tables of a folder, sorted, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.csv")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().getName().removesuffix(".csv") for status in found or [])


def read_all_csv(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All CSV tables of a folder, each read when it is used."""
    return {table: read_csv(spark, folder, table) for table in list_csv(spark, folder)}


def write_csv(tables: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> list[str]:
    """Write each table in parallel part files below ``<folder>/<table>.csv``."""
    paths = []
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}.csv"
        df.write.mode(mode).option("header", True).csv(path)
        paths.append(path)
    return paths
