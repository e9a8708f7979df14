"""A training-corpus pipeline over documents: five stages, each on all that the one before kept.

1. Language identification: documents without a language (null texts and texts without letters) go.
2. N-gram Jaccard join: of documents linked by 5-word shingle sets with a similarity of 0.8 or more, the one with the least id stays.
3. Suffix-array dedup: characters all of whose bytes repeat an earlier 100-byte string are cut out; documents with nothing left go.
4. Benchmark decontamination: documents that hold a window of a benchmark item go.
5. BPE: the ids of what is left, and the text they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.llm import decontamination, jaccard_join, ppm_language, suffix_dedup, word_bpe
from jobweave.llm.common import NULL_ID, row_keys, written
from jobweave.llm.queries import tokenizer


KEY = "_pipeline_key"
#: When two documents are near copies.
NEAR_COPIES = jaccard_join.Rule(words=5, num=80, den=100)


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The documents with a key for each distinct id and text, in the order of ids, and whether rows share a key."""
    return row_keys(docs, "doc_id", "text", KEY)


def _keys(judged: DataFrame) -> DataFrame:
    """Verdicts with the key that an operator gave back as ``doc_id``, the lowest as null."""
    return judged.withColumn(KEY, F.coalesce(F.col("doc_id"), F.lit(NULL_ID)))


def _kept(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The keyed documents whose key is among the chosen ones."""
    return docs.join(_keys(chosen).select(KEY).distinct(), KEY, "left_semi")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. The model learns from the labelled training fold of these documents."""
    keyed, _ = _keyed(docs)
    judged = ppm_language.identify(keyed, ppm_language.fit(docs), id_col=KEY)
    return _kept(keyed, judged.where(F.col("lang_pred") != ppm_language.UNKNOWN)).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies; of rows that repeat an id and its text, the first by the other columns."""
    keyed, shared = _keyed(docs)
    groups = jaccard_join.jaccard_components(keyed, id_col=KEY, rule=NEAR_COPIES)
    kept = _kept(keyed, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))))
    if shared:
        # the least row of a key, combined before the shuffle, however often it is repeated
        kept = kept.groupBy(KEY).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return kept.select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated strings; ``n_chars`` follows the text."""
    keyed, _ = _keyed(docs)
    others = [c for c in docs.columns if c != "text"]
    cut = suffix_dedup.suffix_dedup(keyed, id_col=KEY, whole_characters=True, one_text=True, keep=others)
    left = cut.select(F.col("kept").cast("string").alias("text"), *[F.col(f"keep_{c}").alias(c) for c in others]).where(F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    keyed, _ = _keyed(docs)
    hits = decontamination.decontaminate(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=KEY)
    return _kept(keyed, hits.where("n_hit = 0")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the token ids and their number, and the digests of ids and decoded text."""
    coded = word_bpe.bpe_round_trip(docs, tokenizer("word_bpe_49k.json"))
    return coded.select("doc_id", "ids", *word_bpe.digest_columns())


STAGES = [
    ("language identification", keep_languages),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: Byte contexts, shingle components, repeated byte strings and BPE ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{n}")
    return docs
