"""The whole report as one Spark job: from raw resumes and postings to written tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.functions import fixed, rules
from jobweave.operators import features, matching, metrics, models, recommend, segments, tagging, trends


@dataclass
class ReportInputs:
    """``resumes``: ``resume_id, text``. ``postings``: the columns of the posting schema with a unique
    ``job_id``. ``offers``, optional: the acceptance features, ``accepted_offer`` and ``offer_id``.
    ``interactions``, optional: ``user_id, item_id``, of the types of ``resume_id`` and ``job_id``."""

    resumes: DataFrame
    postings: DataFrame
    offers: DataFrame | None = None
    interactions: DataFrame | None = None


def prepare_resumes(resumes: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    return tagging.preprocess_documents(resumes.select("resume_id", "text"), "text", vocabulary)


def prepare_postings(postings: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Postings with cleaned text and with extracted and listed skills in one list."""
    prepared = tagging.preprocess_documents(postings, "description", vocabulary)
    return prepared.withColumn("skills", rules.merge_skills(F.col("skills"), F.col("skills_required")))


def salary_rows(postings: DataFrame) -> DataFrame:
    """Model features of the postings that name a salary range."""
    return postings.where(rules.has_salary(F.col("salary_min"), F.col("salary_max"))).select(
        "job_id",
        "title",
        "location",
        rules.experience_years(F.col("experience_level")).alias("experience_numeric"),
        rules.skill_count(F.col("skills_required")).alias("num_skills"),
        rules.salary_midpoint(F.col("salary_min"), F.col("salary_max")).alias("salary_midpoint"),
    )


def run_report(
    spark: SparkSession,
    inputs: ReportInputs,
    out_dir: str,
    vocabulary: Sequence[str] = tuple(fixed.DEFAULT_SKILLS),
    top: int = 5,
    clusters: int = 3,
    stop_words: Sequence[str] | None = None,
) -> dict[str, str]:
    """Write every stage as a parquet table and the models beside them; returns table paths.

    Stages read the tables earlier ones wrote, so that none is computed twice and a failed
    run can be looked into. ``out_dir`` must be storage all executors share.
    """
    paths: dict[str, str] = {}

    def keep(name: str, frame: DataFrame) -> DataFrame:
        paths[name] = f"{out_dir}/{name}"
        frame.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    def keep_metrics(name: str, found: dict[str, float]) -> None:
        cells = [F.struct(F.lit(k).alias("metric"), F.lit(float(v)).alias("value")) for k, v in sorted(found.items()) if v is not None]
        keep(name, spark.range(1, numPartitions=1).select(F.inline(F.array(*cells))))

    resumes = keep("resumes", prepare_resumes(inputs.resumes, vocabulary))
    postings = keep("postings", prepare_postings(inputs.postings, vocabulary))

    texts = resumes.select("cleaned_text").unionByName(postings.select("cleaned_text"))
    embedder = features.fit_hashed_embedder(texts, "cleaned_text", stop_words=stop_words)
    left = keep("resume_vectors", features.embed_texts(resumes.select("resume_id", "cleaned_text", "skills"), "cleaned_text", embedder))
    right = keep("posting_vectors", features.embed_texts(postings.select("job_id", "title", "cleaned_text", "skills"), "cleaned_text", embedder))

    ranked = keep("ranked_matches", matching.match_all_topk(left, right, 2 * top))
    keep("matches", ranked.where(F.col("rank") <= top))
    keep("match_histogram", matching.all_scores_histogram(left, right))

    content = ranked.select(F.col("resume_id").alias("user_id"), F.col("job_id").alias("item_id"), "rank")
    peers = None if inputs.interactions is None else recommend.recommend_collaborative(inputs.interactions, n=2 * top)
    keep("recommendations", recommend.recommend_hybrid(content, peers, top))

    labelled = postings.select("job_id", F.col("cleaned_text").alias("cleaned_description"), F.coalesce("experience_level", F.lit("Unknown")).alias("job_category"))
    category = models.train_job_classifier(labelled, "job_id", path=f"{out_dir}/models/category", stop_words=stop_words)
    keep("category_report", category.tables["report"])
    keep("category_confusion", metrics.confusion_matrix(category.tables["test"], "job_category", "predicted_category"))

    salaries = keep("salaries", salary_rows(postings))
    salary = models.train_salary_forecaster(
        salaries, "job_id", path=f"{out_dir}/models/salary", numeric=("experience_numeric", "num_skills")
    )
    keep_metrics("salary_metrics", salary.metrics)
    predicted = keep("salary_predictions", models.predict_salary(salaries, salary.model).select("job_id", "salary_midpoint", "predicted_salary"))
    test = salaries.join(salary.tables["test"].select("job_id"), "job_id", "left_semi")
    keep("salary_actual_vs_predicted", metrics.actual_vs_predicted(test, predicted, "job_id", "salary_midpoint", "predicted_salary"))
    keep("salary_by_title", trends.avg_salary_by_title(salaries, "title", "salary_midpoint"))

    if inputs.offers is not None:
        acceptance = models.train_acceptance_predictor(inputs.offers, "offer_id", path=f"{out_dir}/models/acceptance")
        keep_metrics("acceptance_metrics", acceptance.metrics)
        keep("acceptance_report", acceptance.tables["report"])
        keep("acceptance_confusion", acceptance.tables["confusion"])
        keep("acceptance_predictions", models.predict_acceptance(inputs.offers, acceptance.model).select("offer_id", "acceptance_probability"))
        acceptance.release()

    _, clustered = segments.cluster_jobs(right, "embedding", clusters)
    keep("segments", segments.project_2d(clustered)[0].select("job_id", "cluster", "x", "y"))
    used = trends.posting_skills(postings, "skills", ["job_id"])
    keep("skill_frequency", trends.skill_frequency(used, n=10))
    category.release()
    salary.release()
    return paths
