"""Document folders as tables: list, extract text, set bad files aside."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Mapping
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.session import new_scratch_path

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# File suffixes.
PLAIN_TEXT_SUFFIXES = [".txt", ".json"]
DOCX_SUFFIX = ".docx"
IMAGE_SUFFIXES = [".png", ".jpg", ".jpeg", ".tiff", ".bmp"]
SUPPORTED_SUFFIXES = [".txt", ".json", ".docx", ".pdf", *IMAGE_SUFFIXES]

_WORD_XML = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

Extractor = Callable[[bytes], str]


def docx_text(content: bytes) -> str:
    """The paragraphs of a DOCX file, each followed by a newline."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        root = ElementTree.fromstring(archive.read("word/document.xml"))
    body = root.find(f"{_WORD_XML}body")
    lines = []
    for paragraph in body.findall(f"{_WORD_XML}p") if body is not None else []:
        pieces = []
        for node in paragraph.iter():
            if node.tag == f"{_WORD_XML}t":
                pieces.append(node.text or "")
            elif node.tag == f"{_WORD_XML}tab":
                pieces.append("\t")
            elif node.tag in (f"{_WORD_XML}br", f"{_WORD_XML}cr"):
                pieces.append("\n")
        lines.append("".join(pieces) + "\n")
    return "".join(lines)


DEFAULT_EXTRACTORS: dict[str, Extractor] = {DOCX_SUFFIX: docx_text}


def suffix_of(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def file_name_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


def read_files(spark: SparkSession, path: str, names: str | None = None) -> DataFrame:
    """The files of one folder (sub-folders are not entered) or a single file, of all or of the given names (a glob).
    A bad path gives no rows.

    Spark's file scan leaves out files of zero length by itself.
    """
    from pyspark.errors import AnalysisException

    reader = spark.read.format("binaryFile")
    if names:
        reader = reader.option("pathGlobFilter", names)
    try:
        return reader.load(path)
    except AnalysisException:
        return spark.createDataFrame([], BINARY_SCHEMA)


def extract_text(
    files: DataFrame, extractors: Mapping[str, Extractor] | None = None, only_unknown: bool = False
) -> DataFrame:
    """``file_name, source_path, suffix, raw_content, problem`` for each file; with ``only_unknown`` for those without extractor.

    Plain text is decoded by Spark. Only suffixes with an extractor go through Python, in Arrow
    batches; pass further extractors (PDF, OCR) as ``{suffix: bytes -> str}``. ``problem`` says why a file
    has no content: ``unsupported``, ``no extractor``, ``unreadable``, ``undecodable`` (bytes that are no UTF-8),
    ``malformed JSON`` or ``empty``.
    """
    registry = dict(DEFAULT_EXTRACTORS if extractors is None else extractors)
    named = files.select(
        file_name_of(F.col("path")).alias("file_name"),
        F.col("path").alias("source_path"),
        suffix_of(F.col("path")).alias("suffix"),
        "content",
    )
    decoded = F.col("content").cast("string")
    broken_json = (F.col("suffix") == ".json") & (F.length("content") > 0) & F.try_parse_json(decoded).isNull()
    plain = named.where(F.col("suffix").isin(PLAIN_TEXT_SUFFIXES)).select(
        "file_name",
        "source_path",
        "suffix",
        F.when(F.is_valid_utf8(decoded), decoded).otherwise(F.lit("")).alias("raw_content"),
        F.when(~F.is_valid_utf8(decoded), "undecodable").when(broken_json, "malformed JSON").alias("problem"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, problems = [], []
            for suffix, content in zip(batch["suffix"], batch["content"]):
                try:
                    texts.append(registry[suffix](bytes(content)))
                    problems.append(None)
                except Exception as error:
                    texts.append("")
                    problems.append(f"unreadable: {type(error).__name__}")
            yield pd.DataFrame(
                {
                    "file_name": batch["file_name"],
                    "source_path": batch["source_path"],
                    "suffix": batch["suffix"],
                    "raw_content": texts,
                    "problem": problems,
                }
            )

    coded = [s for s in registry if s not in PLAIN_TEXT_SUFFIXES]
    parsed = named.where(F.col("suffix").isin(coded)).mapInPandas(
        run, "file_name string, source_path string, suffix string, raw_content string, problem string"
    )
    known = [*PLAIN_TEXT_SUFFIXES, *coded]
    rest = named.where(~F.col("suffix").isin(known)).select(
        "file_name",
        "source_path",
        "suffix",
        F.lit("").alias("raw_content"),
        F.when(F.col("suffix").isin(SUPPORTED_SUFFIXES), "no extractor").otherwise("unsupported").alias("problem"),
    )
    everything = rest if only_unknown else plain.unionByName(parsed).unionByName(rest)
    is_empty = F.coalesce(F.length("raw_content"), F.lit(0)) == 0
    return everything.withColumn("problem", F.coalesce("problem", F.when(is_empty, "empty")))


def _any_case(suffix: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def ingest_documents(
    spark: SparkSession, path: str, extractors: Mapping[str, Extractor] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The readable documents of a folder or file, and the files set aside with the reason.

    Files are picked by suffix when they are listed, so contents are read once, and only those of files that are extracted. What was
    extracted is kept in the shared folder, from which both results are read.
    """
    registry = dict(DEFAULT_EXTRACTORS if extractors is None else extractors)
    known = [*PLAIN_TEXT_SUFFIXES, *[s for s in registry if s not in PLAIN_TEXT_SUFFIXES]]
    wanted = read_files(spark, path, "*{" + ",".join(map(_any_case, known)) + "}")
    listed = read_files(spark, path).select("path").where(~suffix_of(F.col("path")).isin(known))
    others = listed.select("path", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("long").alias("length"), F.lit(None).cast("binary").alias("content"))
    scratch = new_scratch_path(spark, "extracted")
    extract_text(wanted, registry).where(F.col("suffix").isin(known)).write.parquet(scratch)
    extract_text(others, registry, only_unknown=True).write.mode("append").parquet(scratch)
    extracted = spark.read.parquet(scratch)
    good = extracted.where(F.col("problem").isNull()).drop("problem")
    return good, extracted.where(F.col("problem").isNotNull()).drop("raw_content")
