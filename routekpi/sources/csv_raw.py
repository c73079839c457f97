"""Raw CSV sources: positional all-text load with the load-time null tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import null_token_frame
from ..schemas import NULL_TOKENS, SEED_SCHEMA, SUBREGION_SEED, all_string_schema

# Report / snapshot year taken from the file path: .../tspr_bus_yearline_2023.csv -> '2023'
# (also .../tspr_bus_yearline_2023.csv/part-00000.csv, a folder written by Spark).
YEAR_FROM_FILE = r"(\d{4})\.csv(?:/[^/]+)?$"


#: Columns of a load that keeps track: the row's file, and the text of a line with too few or too many fields.
SOURCE_FILE, RAGGED_LINE = "source_file", "ragged_line"


def csv_reader(spark: SparkSession, columns, multiline: bool = False, ragged_col: str | None = None):
    """Reader for the raw exports: header line skipped (columns are positional),
    RFC-4180 quotes with doubled-quote escapes, UTF-8, short rows NULL-filled.
    `multiline` allows newlines inside quoted fields; it makes a file one
    split, so turn it off for large files that have none.  `ragged_col` holds
    the text of lines whose number of fields differs."""
    if ragged_col:
        return csv_reader(spark, [*columns, ragged_col], multiline).option("columnNameOfCorruptRecord", ragged_col)
    return (
        spark.read.schema(all_string_schema(columns))
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
    )


def read_raw_csv(spark: SparkSession, paths, columns, source_col: str | None = None,
                 source_pattern: str = YEAR_FROM_FILE, multiline: bool = False,
                 tokens=NULL_TOKENS, track: bool = False) -> DataFrame:
    """All-text DataFrame of the given CSV files.

    The null tokens become NULL on every column.  With `source_col`, the
    label matched by `source_pattern` in each row's file path is added (no match -> NULL).
    With `track` each row has its file and, if it had too few or too many fields, its line.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = csv_reader(spark, columns, multiline, RAGGED_LINE if track else None).csv(paths)
    cols = [F.col(c) for c in columns]
    if track:
        cols += [F.col("_metadata.file_path").alias(SOURCE_FILE), F.col(RAGGED_LINE)]
    if source_col:
        name = F.regexp_extract(F.col("_metadata.file_path"), source_pattern, 1)
        cols.append(F.when(name != "", name).alias(source_col))
    return null_token_frame(df.select(*cols), columns, tokens)


def empty_raw(spark: SparkSession, columns, source_col: str | None = None) -> DataFrame:
    """Empty all-text frame with the raw schema (an optional source file is absent)."""
    cols = list(columns) + ([source_col] if source_col else [])
    return spark.createDataFrame([], all_string_schema(cols))


def union_sources(frames: dict, source_col: str) -> DataFrame:
    """UNION ALL of per-source raw frames, each tagged with its source label."""
    tagged = [df.withColumn(source_col, F.lit(label)) for label, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def seed_frame(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The sub-region seed: typed CSV when `path` is given, else the fixed rows."""
    if path:
        return spark.read.schema(SEED_SCHEMA).option("header", True).csv(path)
    return spark.createDataFrame(list(SUBREGION_SEED), SEED_SCHEMA)
