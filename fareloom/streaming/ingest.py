"""Incremental ingest of arriving trip files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from fareloom.functions.names import month_file_of
from fareloom.functions.values import missing_to_null
from fareloom.operators.conform import conform
from fareloom.operators.ordering import BLOCK, FILE, number_file_rows, with_row_ids
from fareloom.plans.loads import create_target, merge_into
from fareloom.schemas import COLOURS
from fareloom.session import materialise, scratch_path, temporary
from fareloom.sinks.publish import LOAD_ID, abandon_load, begin_load, end_load, is_open, load_history, restore_loads
from fareloom.sinks.tables import create_table
from fareloom.sources.files import CSV_OPTIONS, check_headers, csv_lines, spread_rows, typed_text

# The month file that an arriving row lies in, beside the columns of its file.
ARRIVED_AS = "_arrived_as"


# The number of an arriving line, if its task has the beginning of the file, and its columns.
_LINE, _ROW = "_line", "_row"


def _new_files(spark: SparkSession, limit: int | None) -> DataStreamReader:
    reader = spark.readStream.option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", limit) if limit else reader


def _arrivals(spark: SparkSession, folder: str, schema: T.StructType, file_format: str, limit: int | None) -> DataFrame:
    reader = _new_files(spark, limit)
    if file_format == "parquet":
        return reader.schema(schema).parquet(folder)
    if file_format != "csv":
        raise ValueError(f"no stream of {file_format} files here, only parquet and csv")
    # Columns go by place in a CSV stream; a file whose header says otherwise is an error.
    return reader.schema(_texts(schema)).options(**CSV_OPTIONS).option("enforceSchema", False).csv(folder)


def _texts(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in schema.names])


def _places() -> list[Column]:
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of a micro-batch of headed CSV files, as text columns, with the file of each.

    A gzip file is one task, which does no more than expand it: lines are spread evenly before they are parsed. Columns
    go by place; a file whose header says otherwise is an error. Lines without a letter are no rows, as for Spark's reader.
    """
    spark = lines.sparkSession
    numbered = lines.withColumn(_LINE, F.when(F.col(BLOCK) == 0, F.monotonically_increasing_id())).drop(BLOCK)
    spread = spread_rows(numbered.where(F.col("value").rlike("[^\\x00-\\x20]")))
    text = materialise(spread.select(csv_lines(F.col("value"), schema).alias(_ROW), FILE, _LINE), "arrivals")
    headers = materialise(text.where(F.col(_LINE).isNotNull()).groupBy(FILE).agg(F.min(_LINE).alias(_LINE)), "headers")
    files = [row[FILE] for row in headers.select(FILE).collect()]
    if files:
        check_headers(spark, _texts(schema), files)
    return text.join(headers.select(_LINE), _LINE, "left_anti").select(f"{_ROW}.*", FILE)


def _typed(rows: DataFrame, schema: T.StructType, file_format: str) -> DataFrame:
    """Arrivals under their types; those of Parquet files have them."""
    if file_format == "parquet":
        return rows
    return typed_text(rows.withColumns({name: missing_to_null(F.col(f"`{name}`")) for name in schema.names}), schema)


def ingest_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    colour: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = 1,
    location: str | None = None,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Start a stream that merges every file that is new in ``folder`` and then stops.

    Files are Parquet, or headed CSV (plain or gzip) in the typed layout ``schema``. The stream
    keeps no state: the checkpoint remembers the files, and the merge makes a
    repeated micro-batch harmless. One monthly file per micro-batch gives the outcome of
    monthly loads; several files taken together go in as if one by one in the order of their months, so a
    month that arrives in parts should come in one micro-batch (``files_per_batch=None``
    takes all that is there). Every micro-batch leaves a row in the target's load history.
    """
    fleet = COLOURS[colour]
    create_target(spark, target, fleet, location)
    if file_format == "csv":
        rows = _new_files(spark, files_per_batch).text(folder).select("value", *_places())
    else:
        arrivals = _arrivals(spark, folder, schema, file_format, files_per_batch)
        rows = arrivals.withColumn(ARRIVED_AS, month_file_of(F.col("_metadata.file_path")))

    def merge_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with temporary(session):
            if file_format != "csv":
                typed = conform(batch, fleet, F.col(ARRIVED_AS))
            else:
                # A merge looks at its batch several times: types and keys are made once.
                place = scratch_path(session, "conformed")
                with temporary(session):
                    text = _parsed(batch, schema).withColumn(ARRIVED_AS, month_file_of(F.col(FILE))).drop(FILE)
                    made = conform(_typed(text, schema, file_format), fleet, F.col(ARRIVED_AS))
                    made.write.parquet(place)
                typed = session.read.schema(made.schema).parquet(place)
            merge_into(session, typed, target, fleet, label=f"batch {number}")

    return (
        rows.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    location: str | None = None,
    file_format: str = "csv",
    index: str = "index",
) -> StreamingQuery:
    """Start a stream that appends the rows of every new file in ``folder``, numbered from 0 without a gap, and then stops.

    The number runs on over all micro-batches; within one, files follow by name. The table's load log is the
    ledger: it says how many rows each micro-batch has added, so a later one knows where to go on, and one that is
    repeated after a crash is left out if it is there already, or gets the same numbers if it is not. The table is
    partitioned by load.
    """
    if not spark.catalog.tableExists(table):
        fields = [T.StructField(index, T.LongType()), *schema.fields, T.StructField(LOAD_ID, T.StringType())]
        create_table(spark, table, T.StructType(fields), [LOAD_ID], location, recover=False)
        restore_loads(spark, table)
    rows = _typed(_arrivals(spark, folder, schema, file_format, files_per_batch).select("*", *_places()), schema, file_format)

    def append_batch(batch: DataFrame, number: int) -> None:
        session, label = batch.sparkSession, f"{checkpoint} batch {number}"
        load = begin_load(session, table)
        try:
            ledger = load_history(session, table).agg(
                F.coalesce(F.sum("inserted"), F.lit(0)).alias("rows"), F.count_if(F.col("label") == label).alias("done")
            ).first()
            if ledger.done:
                abandon_load(session, load)
                return
            counted = Observation()
            with temporary(session):
                numbered = number_file_rows(with_row_ids(batch), index)
                numbered = numbered.withColumn(index, F.col(index) + F.lit(ledger.rows)).observe(counted, F.count(F.lit(1)).alias("rows"))
                numbered.write.parquet(load.path("all"))
                inserted = 0 if session.read.schema(numbered.schema).parquet(load.path("all")).isEmpty() else counted.get["rows"]
            end_load(session, load, "all" if inserted else None, inserted, inserted, label, whole=True)
        except BaseException:
            if is_open(load):
                abandon_load(session, load)
            raise

    return rows.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
