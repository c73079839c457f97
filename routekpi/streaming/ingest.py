"""Incremental raw load with Structured Streaming.

The batch load re-reads every report file.  When report files keep arriving
in a landing folder, `ingest_new_files` appends only the files not seen
before to the raw table: a file stream source remembers processed files in
its checkpoint, so with the same checkpoint folder each file is loaded exactly
once, also across restarts and executor loss.  ``trigger(availableNow=True)`` processes what is there
and stops, so the same job runs on a schedule.  Revisions between reports
need no streaming state: staging keeps the newest report's row per key
whenever it is rebuilt from the raw table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.parse import null_token_frame
from ..schemas import NULL_TOKENS, all_string_schema
from ..sources.csv_raw import YEAR_FROM_FILE


def raw_file_stream(spark: SparkSession, landing_dir: str, columns, source_col: str | None = None,
                    source_pattern: str = YEAR_FROM_FILE, file_glob: str = "*.csv",
                    max_files_per_trigger: int | None = None, tokens=NULL_TOKENS, multiline: bool = False) -> DataFrame:
    """Streaming all-text frame of the CSV files landing in `landing_dir`."""
    reader = (
        spark.readStream.schema(all_string_schema(columns))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", file_glob)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(landing_dir)
    cols = [F.col(c) for c in columns]
    if source_col:
        label = F.regexp_extract(F.col("_metadata.file_path"), source_pattern, 1)
        cols.append(F.when(label != "", label).alias(source_col))
    return null_token_frame(df.select(*cols), columns, tokens)


class _RowCount(StreamingQueryListener):
    """Rows read by all micro-batches of one query."""

    def __init__(self, name: str):
        self.name, self.rows, self.ids, self.ended = name, 0, set(), threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.ids.add(event.runId)

    def onQueryProgress(self, event):
        if event.progress.runId in self.ids:
            self.rows += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId in self.ids:
            self.ended.set()


def ingest_new_files(spark: SparkSession, landing_dir: str, table_path: str, columns, checkpoint: str,
                     source_col: str | None = None, name: str = "raw", multiline: bool = False,
                     max_files_per_trigger: int | None = None) -> int:
    """Append the not-yet-loaded files of `landing_dir` to the Parquet table
    at `table_path`; returns the number of rows appended by this run.

    `checkpoint` is the durable folder that remembers the loaded files; give the
    same one on every run.
    """
    stream = raw_file_stream(spark, landing_dir, columns, source_col, max_files_per_trigger=max_files_per_trigger, multiline=multiline)
    count = _RowCount(f"ingest_{name}")
    spark.streams.addListener(count)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", table_path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .queryName(f"ingest_{name}")
            .start()
        )
        query.awaitTermination()
        if not count.ended.wait(60):  # events arrive in order: the last progress comes before the end
            raise RuntimeError(f"the files are loaded into {table_path}, but the rows could not be counted: no end event in 60 s")
    finally:
        spark.streams.removeListener(count)
    return count.rows
