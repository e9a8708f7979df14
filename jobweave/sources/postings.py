"""Job postings as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTING_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("skills_required", T.ArrayType(T.StringType())),
        T.StructField("requirements", T.ArrayType(T.StringType())),
        T.StructField("location", T.StringType()),
        T.StructField("salary_min", T.DoubleType()),
        T.StructField("salary_max", T.DoubleType()),
        T.StructField("experience_level", T.StringType()),
    ]
)

_BAD = "_corrupt_record"


def read_job_postings(
    spark: SparkSession, path: str, schema: T.StructType = POSTING_SCHEMA, one_document_per_file: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Postings, and the records that could not be parsed. The schema is fixed: nothing is inferred."""
    full = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    rows = (
        spark.read.schema(full)
        .option("multiLine", one_document_per_file)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .json(path)
        .withColumn("source_path", F.col("_metadata.file_path"))
    )
    # Spark refuses scans that need the corrupt-record column alone. This is always true and keeps a
    # second field in every scan.
    parsed = F.coalesce(F.length(F.to_json(F.struct(schema.fieldNames()[0]))) >= 0, F.lit(True))
    good = rows.where(F.col(_BAD).isNull() & parsed).drop(_BAD)
    bad = rows.where(F.col(_BAD).isNotNull() & parsed).select("source_path", F.col(_BAD).alias("record"))
    return good, bad


def write_job_postings(df: DataFrame, path: str, one_document_per_file: bool = False) -> None:
    """Postings as JSON.

    Lines of JSON by default. One file per posting is possible for exchange with other tools, by
    limiting the records per file; it is no layout for large tables.
    """
    writer = df.write.mode("overwrite")
    if one_document_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    writer.json(path)
