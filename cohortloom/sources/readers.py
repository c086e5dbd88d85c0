"""Readers with explicit schemas; nothing is inferred, and a cell or row that does not fit is an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from cohortloom.functions.exprs import quoted


def _reader(spark: SparkSession, line_breaks: bool) -> DataFrameReader:
    return spark.read.option("mode", "FAILFAST").option("multiLine", line_breaks).option("escape", '"')


def _as_struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _loose(schema: StructType) -> StructType:
    """Whole-number columns as text: a column with gaps is written with a decimal point by other tools."""
    return StructType([StructField(f.name, StringType() if isinstance(f.dataType, IntegralType) else f.dataType) for f in schema])


def _strict(field: StructField) -> Column:
    cell = quoted(field.name)
    if isinstance(field.dataType, IntegralType):
        digits = F.regexp_extract(cell, r"^\s*([+-]?[0-9]+)(?:\.0*)?\s*$", 1)
        bad = F.raise_error(F.concat(F.lit(f"not a whole number in column {field.name}: "), cell))
        value = F.when(digits != "", digits.cast(field.dataType)).when(F.lower(F.trim(cell)).isin("nan", ""), None)
        return F.when(cell.isNotNull(), value.otherwise(bad.cast(field.dataType))).alias(field.name)
    if field.dataType.typeName() in ("double", "float"):
        return F.nanvl(cell, F.lit(None)).alias(field.name)
    return cell


def read_csv(spark: SparkSession, path: str, schema: StructType | str, line_breaks: bool = False) -> DataFrame:
    """Headed CSV. ``NaN`` is read as null, as it would pass every "at least" test; a whole number may have a decimal
    point with zeros behind it. Any other cell that does not fit its column is an error when it is read.

    ``line_breaks`` allows quoted text to go over several lines. Such a file cannot be split among tasks, so
    large tables of this kind should come as many files. Without it such a row is an error.
    """
    fields = _as_struct(schema)
    df = _reader(spark, line_breaks).schema(_loose(fields)).option("header", True).csv(path)
    return df.select(*map(_strict, fields))


def read_delimited(spark: SparkSession, path: str, sep: str, names: Sequence[str], line_breaks: bool = False) -> DataFrame:
    """Text table without header; all columns are text. A row with more or fewer columns is an error."""
    schema = StructType([StructField(n, StringType()) for n in names])
    return _reader(spark, line_breaks).schema(schema).option("sep", sep).csv(path)


def read_batches(
    spark: SparkSession, glob: str, schema: StructType | str, pattern: str, name: str = "batch", line_breaks: bool = False
) -> DataFrame:
    """All part files of a batch run as one table, with the batch each row came from; cells as in ``read_csv``.

    ``pattern`` is a regular expression with one group that finds the batch in the file path.
    """
    fields = _as_struct(schema)
    reader = _reader(spark, line_breaks).schema(_loose(fields)).option("header", True)
    df = reader.option("recursiveFileLookup", True).csv(glob)
    return df.select(*map(_strict, fields), F.regexp_extract("_metadata.file_path", pattern, 1).alias(name))


def read_review(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One exported review sheet: Parquet, or CSV if the path says so. Notes may go over several lines."""
    return read_csv(spark, path, schema, line_breaks=True) if path.endswith(".csv") else spark.read.schema(schema).parquet(path)


def list_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Files below ``root`` whose name fits, as (path, folder, length). File content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return files.load(root).select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "length")
