"""Views that give the input tables the roles the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.functions import rules
from jobweave.functions.text import clean_text, match_terms
from jobweave.operators.joins import salted_join

# Vocabulary that occurs in the test documents.
TEST_SKILLS = [
    "that", "with", "this", "from", "ther", "thon", "thre", "para", "ción", "mente", "pour", "dans", "avec",
    "sich", "nicht", "eine", "of the", "the and", "is the", "ai",
]

# Stop words of the registered queries.
TEST_STOP_WORDS = [
    "the", "and", "of", "is", "to", "in", "that", "with", "this", "from", "by", "for", "it", "as", "on", "are",
    "be", "or", "at", "an", "was", "which", "le", "la", "les", "de", "des", "un", "une", "qui", "que", "dans",
    "der", "die", "das", "und", "el", "los", "para", "con",
]

# Gazetteer rows; nations and regions are added from their tables.
TEST_GAZETTEER = [
    ("PERSON", "with"), ("PERSON", "this"), ("ORG", "of the"), ("ORG", "the and"), ("DATE", "from"),
    ("MONEY", "para"), ("PRODUCT", "avec"), ("PRODUCT", "ai"), ("LOC", "is the"), ("GPE", "sich"),
]

# Order priority to years of experience; any other value takes the default.
PRIORITY_YEARS = {"1-URGENT": 1, "2-HIGH": 3, "3-MEDIUM": 5, "4-NOT SPECIFIED": 7}

# Product words that stand for skills the salary rule knows.
RULE_SKILLS = {"small": "python", "red": "aws", "blue": "cloud"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_rows(spark: SparkSession, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """A few constant rows, made inside the JVM."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _with_embedding(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return docs.join(vectors, "doc_id", "left")


def resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents somebody labelled play resumes; the embedding may be missing."""
    labelled = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return _with_embedding(spark, sf_dir, labelled).select(F.col("doc_id").alias("resume_id"), "text", "embedding")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other documents play job postings."""
    rest = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")
    return _with_embedding(spark, sf_dir, rest).select(
        F.col("doc_id").alias("job_id"),
        F.col("source").alias("title"),
        F.col("lang").alias("category"),
        F.col("text").alias("description"),
        "embedding",
    )


def with_skills(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn("skills", match_terms(clean_text(F.col(text_col)), TEST_SKILLS))


def matching_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return with_skills(resumes(spark, sf_dir), "text"), with_skills(jobs(spark, sf_dir), "description")


def event_items(spark: SparkSession, sf_dir: str, *event_types: str) -> DataFrame:
    """``user_id, item_id, event_type`` per event of the given types."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(list(event_types)))
    item = F.get_json_object("props", "$.k").try_cast("bigint")
    return events.select("user_id", item.alias("item_id"), "event_type").where(F.col("item_id").isNotNull())


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_items(spark, sf_dir, "click", "purchase").select("user_id", "item_id").distinct()


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``resume_id, job_id, hired``: who clicked on or bought what, by resume and job id."""
    pairs = event_items(spark, sf_dir, "click", "purchase").groupBy("user_id", "item_id").agg(
        F.max((F.col("event_type") == "purchase").cast("int")).alias("hired")
    )
    docs, labels = documents(spark, sf_dir).select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    resume_ids = docs.join(labels, "doc_id", "left_semi").withColumnRenamed("doc_id", "resume_id")
    job_ids = docs.join(labels, "doc_id", "left_anti").withColumnRenamed("doc_id", "job_id")
    return (
        pairs.withColumnsRenamed({"user_id": "resume_id", "item_id": "job_id"})
        .join(resume_ids, "resume_id", "left_semi")
        .join(job_ids, "job_id", "left_semi")
        .select("resume_id", "job_id", "hired")
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers of nations as dated postings with a salary range."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    return joined.select(
        F.col("o_orderkey").alias("job_id"),
        F.col("c_mktsegment").alias("title"),
        F.col("n_name").alias("location"),
        F.col("o_orderpriority").alias("experience_level"),
        (F.col("o_totalprice") * 0.9).alias("salary_min"),
        (F.col("o_totalprice") * 1.1).alias("salary_max"),
        F.col("o_orderdate").alias("date_posted"),
        F.col("o_orderstatus").alias("status"),
        F.col("n_regionkey").alias("region"),
    )


def salary_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select(
        "job_id",
        "title",
        "location",
        rules.experience_years(F.col("experience_level"), PRIORITY_YEARS).alias("experience_numeric"),
        rules.salary_midpoint(F.col("salary_min"), F.col("salary_max")).alias("salary_midpoint"),
    )


def title_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each posting's salary beside the mean of its title: a naive prediction."""
    rows = salary_features(spark, sf_dir)
    means = rows.groupBy("title").agg(F.avg("salary_midpoint").alias("predicted"))
    return salted_join(rows, means, "title", ["job_id"])


def posting_skill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per skill use of a posting: ``job_id, date_posted, skill``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("date_posted"), F.explode("words").alias("skill")
    )


def part_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as salary requests: ``request_id, skills, years, location, listed``."""
    words = F.split("p_name", " ")
    renamed = F.transform(words, lambda w: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in RULE_SKILLS.items() for x in kv]), w), w))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("request_id"),
        renamed.alias("skills"),
        F.col("p_size").alias("years"),
        F.when(F.col("p_type") == "ECONOMY", "San Francisco, CA").when(F.col("p_type") == "PROMO", None).otherwise("Remote").alias("location"),
        F.when(F.col("p_type") != "PROMO", F.array(F.lower("p_type"), F.lower("p_brand"))).alias("listed"),
    )


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as offers to candidates, with the features of the acceptance model."""
    p = postings(spark, sf_dir).withColumn("mid", rules.salary_midpoint(F.col("salary_min"), F.col("salary_max")))
    means = p.groupBy("title").agg(F.avg("mid").alias("market"))
    return salted_join(p, means, "title", ["job_id"]).select(
        F.col("job_id").alias("offer_id"),
        ((F.col("job_id") % 100) / F.lit(100.0)).alias("match_score"),
        rules.salary_diff_percentage(F.col("mid"), F.col("market")).alias("salary_diff_percentage"),
        rules.experience_years(F.col("experience_level"), PRIORITY_YEARS).alias("candidate_experience_years"),
        (F.col("region") % 2).cast("int").alias("is_remote"),
        (F.col("status") == "F").cast("int").alias("accepted_offer"),
    )


def language_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, actual, predicted``: the language of a document and a guess from common words."""
    padded = F.concat(F.lit(" "), clean_text(F.col("text")), F.lit(" "))
    guess = (
        F.when(padded.contains(" the "), "en")
        .when(padded.contains(" le ") | padded.contains(" la "), "fr")
        .when(padded.contains(" der ") | padded.contains(" die "), "de")
        .otherwise("es")
    )
    return documents(spark, sf_dir).select("doc_id", F.col("lang").alias("actual"), guess.alias("predicted"))


def purchase_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as scores for the label "is a purchase"."""
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_type") == "purchase").cast("int").alias("label"), F.col("value").alias("score")
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed_rows = literal_rows(spark, ("label", "phrase"), TEST_GAZETTEER)
    nations = table(spark, sf_dir, "nation").select(F.lit("GPE").alias("label"), F.lower("n_name").alias("phrase"))
    regions = table(spark, sf_dir, "region").select(F.lit("LOC").alias("label"), F.lower("r_name").alias("phrase"))
    return fixed_rows.unionByName(nations).unionByName(regions)

