"""Incremental silver: raw documents arriving on a stream become silver rows per micro-batch.

The document stages (one document per entity, dialect folding, parse, explode) work
per document, so they run unchanged on each micro-batch. ``foreachBatch`` parses the
batch once into the shared folder, fans it out to the 21 silver tables and deletes the copy. Each
batch writes under its own ``batch_id=N`` folder with overwrite, so a batch replayed
after a failure rewrites the same files (exactly-once output with the checkpoint).

Deduplication is per batch: an entity whose document arrives again in a later batch
gets new rows there; a periodic batch run of :func:`strata.plans.registry.run`
over the whole source settles replacements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.layout import materialize
from ..plans import registry as R
from ..session import staging

RAW_SCHEMA = StructType([
    StructField("id", LongType()), StructField("krs_number", StringType()), StructField("raw_data", StringType())
])


def silver_batch_writer(out_root: str, fmt: str = "parquet", on_error: str = "fail"):
    """The ``foreachBatch`` function: bronze + parse once, then the 21 silver tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staging(spark):
            parsed = materialize(R.normalise(R.bronze(batch)), fmt=fmt)
            tables = R.silver(None, on_error, parsed=parsed)
            jobs = {n: (t, f"{out_root}/{n}/batch_id={batch_id}") for n, t in tables.items()}
            R.write_tables(jobs, fmt, 4, atomic=False)

    return write


def start_silver_stream(
    spark: SparkSession,
    source_path: str,
    out_root: str,
    checkpoint_location: str,
    source_format: str = "parquet",
    schema: StructType = RAW_SCHEMA,
    available_now: bool = False,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
    on_error: str = "fail",
) -> StreamingQuery:
    """Start the incremental silver stream over files of raw rows ``(id, krs_number, raw_data)``.

    ``checkpoint_location`` must be the same folder in every run: it holds which batches are
    done, so a restart goes on where the stream stopped instead of numbering batches anew.
    """
    reader = spark.readStream.format(source_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(source_path)
    writer = raw.writeStream.foreachBatch(silver_batch_writer(out_root, fmt, on_error))
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
