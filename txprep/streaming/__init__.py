"""Row-wise preparation stages over delimited files as they arrive.

Validation, the outlier fence (bounds supplied, e.g. from a batch profile),
label consistency and the features are stateless, so they run unchanged on
a streaming DataFrame. The output goes to Spark's file sink, which is
exactly-once (its commit log lives next to the data and the offsets in the
checkpoint), partitioned by label like the batch job. Deduplication by id is
stateful: ids are kept in the state store for ``dedup_within`` after their
first row arrived (a watermark on the time of arrival), so the state is bounded by
what arrives in that time. The fence statistics need the whole table and stay
in the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import check_consistency, remove_outliers, validate
from ..operators.features import add_features, select_ml_ready
from ..schema import DEFAULT_COLUMNS, TX_SCHEMA, TxColumns
from ..sinks import MAX_RECORDS_PER_FILE

#: Name of the time of arrival while the stream is deduplicated.
ARRIVED = "_arrived"


def stream_rows(stream: DataFrame, bounds: Row | None, cols: TxColumns = DEFAULT_COLUMNS,
                dedup_within: str | None = None) -> DataFrame:
    """The stages on a (streaming or batch) DataFrame, in the batch job's order.

    ``dedup_within`` (a streaming DataFrame only) keeps the first row of an id
    that arrives and drops those that follow within that time. The event's own
    time would not do: it may be missing or wrong, and a late event is no
    duplicate."""
    valid = validate(stream, cols)
    fenced = remove_outliers(valid, bounds, cols) if bounds is not None else valid
    if dedup_within is not None:
        fenced = fenced.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, dedup_within) \
            .dropDuplicatesWithinWatermark([cols.id]).drop(ARRIVED)
    return select_ml_ready(add_features(check_consistency(fenced, cols), cols), cols)


def stream_prepare(spark: SparkSession, source_dir: str, output_path: str, bounds: Row | None = None,
                   cols: TxColumns = DEFAULT_COLUMNS, *, checkpoint: str,
                   available_now: bool = True, max_files_per_trigger: int | None = None,
                   processing_time: str | None = None, dedup_within: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    ``checkpoint`` belongs to ``output_path``: a restart with the same folder
    goes on after the last committed file; a new folder with an old output would
    count its batches from 0 again and lose files to the sink's own log. Without
    ``dedup_within`` (e.g. ``"7 days"``) rows are not deduplicated."""
    reader = (spark.readStream.schema(TX_SCHEMA).option("header", True).option("escape", '"')
              .option("mode", "PERMISSIVE"))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = stream_rows(reader.csv(source_dir), bounds, cols, dedup_within)
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
              .partitionBy(cols.label))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(output_path)
