"""Batch scoring (I6/I7) as a Structured Streaming query.

The reference scores a CSV file chunk by chunk.  Here the chunks are the
micro-batches of a file-source stream (``maxFilesPerTrigger`` files each):
each micro-batch is scored as a whole with the fitted
feature ``PipelineModel`` and classifier, explained, stamped with its batch
number and its sample ids and written to ``<output>/batch_id=<n>``.  Scoring is
stateless per row, so nothing is kept in state stores.

Ledger.  Every micro-batch ends with one row in ``<output>_ledger/batch_id=<n>``:
its status, its first sample id and row count, its files, and the error if it
failed.  A chunk that cannot be read or scored is logged and skipped: its batch id stays
unused, its row in the ledger (the dead letters, :func:`failed_chunks`) names the files,
and the stream goes on.  That every chunk failed is an error
(:func:`finish`).  A stopped Spark context is no fault of a chunk and ends the stream.

Sample ids run over all chunks: a chunk starts where the ledger row of the one before it
ends, so each micro-batch reads one row, however long the stream.  A replayed
micro-batch reads the same row, gives the same ids and overwrites its own
folders; the stream's checkpoint (under the shared checkpoint folder) makes the job
resumable after a driver or executor loss.

A failed chunk takes sample ids only if its rows can still be counted (it was read but not
scored); a chunk that cannot be read takes none.
"""

from __future__ import annotations

import logging
import os
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saferow.functions.exprs import nan_to_null
from saferow.operators.features import FittedFeatures
from saferow.operators.models import TrainedModel
from saferow.operators.quality import row_errors
from saferow.operators.ranks import row_index
from saferow.operators.scoring import explain, score
from saferow.session import scratch_path
from saferow.spec import FOOD_SAFETY, TableSpec

log = logging.getLogger(__name__)

LEDGER = ("status string, first_sample_id long, n_rows long, next_sample_id long, files array<string>, error string")
#: Characters of an error that the ledger keeps.
ERROR_CHARS = 2000


def _ledger(output_dir: str) -> str:
    return output_dir.rstrip("/") + "_ledger"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001


def _files_of(spark: SparkSession, checkpoint: str, epoch_id: int) -> list[str]:
    """The files of a micro-batch, from the file source's own log in the checkpoint."""
    log_files = f"{checkpoint}/sources/0/{{{epoch_id},{epoch_id}.compact}}"
    entries = spark.read.text(log_files).where("value LIKE '{%'") \
        .select(F.from_json("value", "path string, batchId long").alias("e")).where(F.col("e.batchId") == epoch_id)
    return [r[0] for r in entries.select("e.path").collect()]


def score_chunk(batch: DataFrame, batch_id: int, model: TrainedModel, features: Optional[FittedFeatures],
                output_dir: str, spec: TableSpec = FOOD_SAFETY, model_path: str = "", n_features: int = 5,
                files: Sequence[str] = ()) -> None:
    """Score one chunk (of these ``files``) and enter it in the ledger; what goes wrong with it is entered too."""
    spark = batch.sparkSession
    out = os.path.join(output_dir, f"batch_id={batch_id}")
    objections = os.path.join(output_dir + "_quarantine", f"batch_id={batch_id}")
    first = 0 if batch_id == 1 else \
        spark.read.schema(LEDGER).parquet(os.path.join(_ledger(output_dir), f"batch_id={batch_id - 1}")).first()["next_sample_id"]
    keep = [c for c in batch.columns if c != spec.target]
    status, error, rows = "scored", None, None
    try:
        # the numbered rows are written once: what follows reads them, not the chunk
        rows = row_index(batch, [spec.key] if spec.key in batch.columns else batch.columns, out="sample_id") \
            .withColumn("sample_id", F.col("sample_id") + F.lit(first))
        scored = score(rows, model, features, spec, keep=keep + ["sample_id"])
        told = explain(scored, F.col("prediction"), F.col("confidence"), spec, n_features,
                       keep=keep + ["sample_id", "prob_safe", "prob_unsafe"])
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        (told.withColumn("prediction_timestamp", stamp).withColumn("model_path", F.lit(model_path))
         .write.mode("overwrite").parquet(out))
        (rows.withColumn("errors", row_errors(spec, spec.feature_columns)).where(F.size("errors") > 0)
         .withColumn("errors", F.concat_ws(",", "errors")).write.mode("overwrite").parquet(objections))
    except Exception as e:  # noqa: BLE001 - a chunk that fails is skipped and entered in the ledger
        if spark.sparkContext._jsc.sc().isStopped():  # noqa: SLF001
            raise
        log.error("chunk %d is skipped: %s", batch_id, e)
        status, error = "failed", str(e)[:ERROR_CHARS]
        _delete(spark, out)
        _delete(spark, objections)
    n_rows = 0 if rows is None else rows.count()
    entry = [(status, first, n_rows, first + n_rows, list(files), error)]
    spark.createDataFrame(entry, LEDGER).coalesce(1).write.mode("overwrite") \
        .parquet(os.path.join(_ledger(output_dir), f"batch_id={batch_id}"))


def stream_score(spark: SparkSession, input_dir: str, schema: T.StructType, model: TrainedModel,
                 features: Optional[FittedFeatures], output_dir: str, checkpoint: Optional[str] = None,
                 files_per_batch: int = 1, spec: TableSpec = FOOD_SAFETY, model_path: str = "",
                 n_features: int = 5, available_now: bool = True):
    """Start the scoring stream over CSV files in ``input_dir``; returns the query.

    With ``available_now`` the query processes what is there and stops (the
    batch job, to be ended with :func:`finish`); otherwise it keeps scoring new files as
    they arrive.  A file whose header is not that of ``schema`` fails its chunk.
    """
    src = (spark.readStream.schema(schema).option("header", True).option("nullValue", "NA")
           .option("escape", '"').option("enforceSchema", False)
           .option("maxFilesPerTrigger", files_per_batch).csv(input_dir))
    src = nan_to_null(src)
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        score_chunk(batch, epoch_id + 1, model, features, output_dir, spec, model_path, n_features,
                    _files_of(batch.sparkSession, checkpoint, epoch_id))

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_ledger(spark: SparkSession, output_dir: str) -> DataFrame:
    """One row per chunk: batch_id, status, first_sample_id, n_rows, next_sample_id, files, error."""
    return spark.read.schema(LEDGER + ", batch_id long").parquet(_ledger(output_dir))


def failed_chunks(spark: SparkSession, output_dir: str) -> DataFrame:
    """The dead letters: batch_id, files and error of the chunks that were skipped."""
    return read_ledger(spark, output_dir).where("status = 'failed'").select("batch_id", "files", "error")


def finish(spark: SparkSession, query, output_dir: str) -> DataFrame:
    """Wait for an ``available_now`` query; its ledger, or an error if no chunk was scored."""
    query.awaitTermination()
    ledger = read_ledger(spark, output_dir)
    if ledger.where("status = 'scored'").isEmpty():
        raise RuntimeError(f"no chunk was scored, see {_ledger(output_dir)}")
    return ledger


def read_scored(spark: SparkSession, output_dir: str) -> DataFrame:
    """The scored rows written by :func:`stream_score` (``batch_id`` from the folders)."""
    return spark.read.parquet(output_dir)
