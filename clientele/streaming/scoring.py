"""Score customer files as they arrive, with a model fitted in batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def score_files(spark: SparkSession, model: PipelineModel, spec, source_dir: str, schema: T.StructType,
                sink_dir: str, checkpoint_location: str, prepare=None, fmt: str = "parquet",
                trigger_once: bool = True):
    """Structured Streaming file source -> ``prepare`` (features) -> model scoring -> file sink.

    ``prepare(batch_df) -> DataFrame`` turns raw rows into model inputs (for
    example the projection-only feature steps).  The query checkpoints its
    progress in ``checkpoint_location`` (shared storage), so a restarted or
    failed job resumes without rescoring or skipping files.

    Each micro-batch is written to its own ``batch_id=<n>`` folder under
    ``sink_dir`` in overwrite mode.  A batch that is run again after a restart
    (its output committed, its progress not yet) replaces its own folder
    instead of appending a second copy, so the sink holds every row exactly
    once.  Reading ``sink_dir`` yields a ``batch_id`` partition column.
    """
    from clientele.operators.modeling import score

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        frame = prepare(batch) if prepare else batch
        out = f"{sink_dir.rstrip('/')}/batch_id={batch_id}"
        score(model, frame, spec).write.mode("overwrite").format(fmt).save(out)

    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
