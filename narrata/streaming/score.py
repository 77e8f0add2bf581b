"""Score complaints as they arrive (S4) with Structured Streaming.

The stream is read with an explicit schema; every micro-batch goes through
the *same* batch operators (clean -> lexicon score -> label -> name) inside
``foreachBatch``, so stream and batch results are identical by construction.
A lexicon that fits the plan is looked up within the row: a micro-batch is
then one pass without any exchange. Lexicons and models given as a path are
read again for every micro-batch, so one written in their place is taken up.
Each micro-batch overwrites its own ``epoch=<id>`` folder, which makes a
retried batch idempotent (exactly-once output with the checkpointed offsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from narrata.functions import text as T
from narrata.operators import sentiment as S
from narrata.operators import word_bayes as WB

DOCUMENT_SCHEMA = TY.StructType([
    TY.StructField("doc_id", TY.LongType()),
    TY.StructField("text", TY.StringType()),
    TY.StructField("lang", TY.StringType()),
    TY.StructField("source", TY.StringType()),
    TY.StructField("n_chars", TY.LongType()),
])


def score_batch(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Batch scoring of raw documents: the function every micro-batch runs."""
    cleaned = docs.select(F.col("doc_id").alias("complaint_id"), F.col("lang").alias("product"), "text")
    cleaned = T.with_computed(cleaned, clean=T.clean_narrative("text")).filter(F.col("clean") != "").drop("text")
    scored = S.lexicon_sentiment(cleaned, "complaint_id", "clean", lexicon, keep=["product"])
    return scored.select("complaint_id", "product", "sentiment",
                         S.sentiment_names("sentiment").alias("sentiment_name"))


def classify_batch(docs: DataFrame, model: WB.Model) -> DataFrame:
    """Batch classification of raw documents by a loaded naive Bayes model."""
    cleaned = T.with_computed(docs.select(F.col("doc_id").alias("complaint_id"), "text"),
                              clean=T.clean_narrative("text")).filter(F.col("clean") != "")
    scored = WB.score(cleaned, "clean", model, ["complaint_id"])
    return scored.select("complaint_id", F.col("predicted").alias("predicted_response"), "probability")


def _start(spark: SparkSession, source_dir: str, batch_fn, sink_dir: str, checkpoint_location: str, glob: str,
           available_now: bool, max_files_per_trigger: int | None):
    reader = spark.readStream.schema(DOCUMENT_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch_fn(batch).write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def classify_stream(spark: SparkSession, source_dir: str, model_path: str, sink_dir: str, checkpoint_location: str,
                    glob: str = "*.parquet", available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start a stream that classifies arriving documents by a saved model; returns the StreamingQuery.

    The model is read again for every micro-batch, so one written in its place is taken up by the next.
    """
    return _start(spark, source_dir, lambda batch: classify_batch(batch, WB.load(batch.sparkSession, model_path)), sink_dir,
                  checkpoint_location, glob, available_now, max_files_per_trigger)


def score_stream(spark: SparkSession, source_dir: str, lexicon: DataFrame | str, sink_dir: str,
                 checkpoint_location: str, glob: str = "*.parquet",
                 available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the streaming scorer; returns the StreamingQuery.

    ``lexicon`` is a table, or the path of a written one that is read again for every micro-batch.
    """
    def run(batch: DataFrame) -> DataFrame:
        return score_batch(batch, batch.sparkSession.read.parquet(lexicon) if isinstance(lexicon, str) else lexicon)
    return _start(spark, source_dir, run, sink_dir, checkpoint_location, glob, available_now, max_files_per_trigger)
