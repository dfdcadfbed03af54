"""Readers with explicit schemas; nothing is inferred, so a read starts no job.

An empty field and a missing trailing field are both read as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logstats import schemas


def read_machine_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The 27-column log: no header, ``~`` as the quote character."""
    reader = spark.read.schema(schemas.MACHINE_LOG).option("header", False)
    return reader.option("quote", "~").csv(path)


# The column with the whole line of a row that is not as long as the schema, else null.
CORRUPT = "corrupt_line"


def read_machine_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The log with ``corrupt_line``: the text of a line that has not exactly 27 fields.

    Spark does not answer queries on that column alone from the files, so write or checkpoint
    these rows before they are split into ``good_rows`` and ``quarantined``.
    """
    schema = T.StructType([*schemas.MACHINE_LOG.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE")
    # Without pruning, a line is cut into all its fields, whatever columns are read.
    reader = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("quote", "~").csv(path)


def good_rows(lines: DataFrame) -> DataFrame:
    """Rows of well-formed lines, in the columns of the log."""
    return lines.filter(_fault().isNull()).drop(CORRUPT)


def quarantined(lines: DataFrame) -> DataFrame:
    """``fault`` (short, long or quote) and ``line`` of the malformed lines.

    A quote that is not closed takes the rest of the line into one field, so the number of
    fields says nothing about such a line; an escaped quote does not count.
    """
    return lines.select(_fault().alias("fault"), F.col(CORRUPT).alias("line")).filter("fault IS NOT NULL")


def _fault() -> Column:
    line = F.col(CORRUPT)
    quotes = F.regexp_count(F.replace(line, F.lit("\\~"), F.lit("")), F.lit("~"))
    outside = F.regexp_replace(line, "~[^~]*~", "")
    fields = F.regexp_count(outside, F.lit(",")) + 1
    width = len(schemas.MACHINE_LOG.names)
    return F.when(line.isNotNull(), F.when(quotes % 2 == 1, "quote").when(fields < width, "short").otherwise("long"))


def read_system_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(schemas.SYSTEM_LIST).option("header", False).csv(path)


def read_level_weights(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(schemas.LEVEL_WEIGHTS).option("header", True).csv(path)


def read_code_actions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Leading blanks are part of a description, so fields are not trimmed."""
    return spark.read.schema(schemas.CODE_ACTIONS).option("header", True).csv(path)
