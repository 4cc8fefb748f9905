"""Score feature files as they land (batch scoring, M15, as a file stream).

Each micro-batch is one batch of new rows: it is scored with the saved model
bundle and gets its own prediction interval (the spread is that of the
batch's predictions, as in one-off batch scoring).  ``foreachBatch`` writes
each batch to a run-named folder; the stream's progress lives in a
checkpoint folder that the caller names, so a restarted query resumes where
it stopped and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phenocast.plans.pipeline import predictions_table
from phenocast.sources import schemas
from phenocast.sources.model_store import load_model_bundle
from phenocast.sources.writers import write_csv


def score_stream(spark: SparkSession, input_dir: str, model_path: str, output_dir: str,
                 checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None):
    """Start a streaming query scoring every new CSV file in ``input_dir``.

    ``checkpoint`` is the shared folder of this stream's progress; a restart with the
    same folder takes up only files that are new.
    Returns the ``StreamingQuery``; with ``available_now`` it processes the
    files present and stops (call ``awaitTermination()``).
    """
    fitted = load_model_bundle(spark, model_path)
    reader = (spark.readStream.schema(schemas.SCORING_INPUT).option("header", True)
              .option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(input_dir)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = batch.select("location", *fitted.features)
        scored = fitted.transform(rows, "_raw").persist()
        try:
            out = predictions_table(fitted, rows, scored=scored)
            # a batch that is replayed after a failure rewrites its own folder
            write_csv(out, f"{output_dir.rstrip('/')}/batch={batch_id}", mode="overwrite")
        finally:
            scored.unpersist()

    writer = rows.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
