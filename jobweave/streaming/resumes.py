"""Drop-folder scoring: resumes that arrive as files are matched against the postings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobweave.functions import fixed
from jobweave.functions.text import has_content, upload_preview
from jobweave.operators.features import embed_texts
from jobweave.operators.matching import match_all_topk
from jobweave.operators.tagging import preprocess_documents
from jobweave.sources.documents import BINARY_SCHEMA, Extractor, extract_text


def score_resumes(
    documents: DataFrame,
    jobs: DataFrame,
    embedder: PipelineModel,
    n: int = 5,
    vocabulary: Sequence[str] = tuple(fixed.DEFAULT_SKILLS),
) -> DataFrame:
    """Top postings per ingested document, keyed by its path, with the upload preview."""
    usable = documents.where(has_content(F.col("raw_content")))
    resumes = preprocess_documents(
        usable.select(F.col("source_path").alias("resume_id"), "file_name", "raw_content"), "raw_content", vocabulary
    )
    embedded = embed_texts(resumes, "cleaned_text", embedder)
    best = match_all_topk(embedded, jobs, n)
    shown = resumes.select("resume_id", "file_name", upload_preview(F.col("raw_content")).alias("preview"))
    return best.join(shown, "resume_id")


def start_scoring_stream(
    spark: SparkSession,
    inbox: str,
    jobs: DataFrame,
    embedder: PipelineModel,
    output: str,
    checkpoint: str,
    n: int = 5,
    vocabulary: Sequence[str] = tuple(fixed.DEFAULT_SKILLS),
    extractors: Mapping[str, Extractor] | None = None,
    max_files: int = 10_000,
) -> StreamingQuery:
    """Score what lies in ``inbox`` and has not been scored, then stop (``availableNow``).

    ``jobs`` brings ``job_id``, ``skills`` and ``embedding``. The query keeps no state. Each
    micro-batch overwrites its own output folder, so a batch repeated after a failure leaves no
    duplicate; files that could not be read go to a folder beside it.
    """
    files = (
        spark.readStream.schema(BINARY_SCHEMA).format("binaryFile").option("maxFilesPerTrigger", max_files).load(inbox)
    )

    def score(batch: DataFrame, batch_id: int) -> None:
        extracted = extract_text(batch, extractors).persist()
        good = extracted.where(F.col("problem").isNull())
        matches = score_resumes(good, jobs, embedder, n, vocabulary)
        matches.write.mode("overwrite").parquet(f"{output}/matches/batch_id={batch_id}")
        bad = extracted.where(F.col("problem").isNotNull()).drop("raw_content")
        bad.write.mode("overwrite").parquet(f"{output}/set_aside/batch_id={batch_id}")
        extracted.unpersist()

    return (
        files.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
