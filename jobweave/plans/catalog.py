"""The registered queries: each operator applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.functions import fixed, rules, text
from jobweave.functions.vectors import norm
from jobweave.operators import features, matching, metrics, models, recommend, segments, skill_join, splits, tagging, terms, trends
from jobweave.plans import views
from jobweave.plans.views import TEST_SKILLS, TEST_STOP_WORDS, table
from jobweave.session import new_scratch_path, written
from jobweave.sources import postings as posting_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def listed(name: str) -> Column:
    """An array column as text, so that results compare alike in every engine."""
    return F.array_join(F.col(name), "|").alias(name)


# --- sources and service views ------------------------------------------------------------


@register
def write_job_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings written as JSON to the shared folder and read back with the fixed schema."""
    path = new_scratch_path(spark, "postings")
    rows = views.postings(spark, sf_dir).select(
        F.col("job_id").cast("string").alias("job_id"), "title", "location", "salary_min", "salary_max", "experience_level"
    )
    posting_files.write_job_postings(rows, path)
    good, _ = posting_files.read_job_postings(spark, path, one_document_per_file=False)
    return good.select("job_id", "title", "location", r6("salary_min"), r6("salary_max"), "experience_level")


@register
def upload_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir).select("doc_id", text.upload_preview(F.col("text")).alias("preview"))


@register
def list_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = views.with_skills(views.jobs(spark, sf_dir), "description")
    return jobs.select("job_id", "title", "description", listed("skills"))


# --- text ---------------------------------------------------------------------------------


@register
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("cleaned_text"))


@register
def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir).select("doc_id", text.preview(F.col("text")).alias("preview"))


@register
def extract_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.with_skills(views.documents(spark, sf_dir), "text")
    return docs.select("doc_id", listed("skills"))


@register
def match_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills by the join form, on raw text, with a vocabulary table made of product words as well."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("term"))
    vocabulary = words.unionByName(views.literal_rows(spark, ("term",), [(t,) for t in TEST_SKILLS]))
    return tagging.match_vocabulary(views.documents(spark, sf_dir), "doc_id", "text", vocabulary)


@register
def extract_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", text.extract_emails(F.col("text")).alias("emails"))
    return docs.select("doc_id", listed("emails"))


@register
def extract_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", text.extract_phone_numbers(F.col("text")).alias("phones"))
    return docs.select("doc_id", listed("phones"))


@register
def tag_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("cleaned_text"))
    tagged = tagging.tag_entities(docs, "doc_id", "cleaned_text", views.gazetteer(spark, sf_dir))
    # Every label is there; the outer form spares the texts a second search by a filter on the map's size.
    rows = tagged.select("doc_id", F.explode_outer("entities").alias("label", "mentions"))
    return rows.select("doc_id", "label", listed("mentions"))


@register
def merge_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = views.part_requests(spark, sf_dir).withColumn("merged", rules.merge_skills(F.col("skills"), F.col("listed")))
    return merged.select("request_id", listed("merged"))


@register
def preprocess_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", "text")
    record = tagging.preprocess_documents(docs, "text", TEST_SKILLS)
    return record.select(
        "doc_id", "original_text_preview", "cleaned_text", listed("skills"), listed("emails"), listed("phone_numbers")
    )


@register
def preprocess_with_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole record; the mentions of all labels as one text."""
    docs = views.documents(spark, sf_dir).select("doc_id", "text")
    record = tagging.preprocess_with_entities(docs, "doc_id", "text", views.gazetteer(spark, sf_dir), TEST_SKILLS)
    mentions = [F.concat(F.lit(f"{name}="), F.array_join(F.col("entities")[name], "|")) for name in fixed.ENTITY_LABELS]
    return record.select(
        "doc_id", "original_text_preview", "cleaned_text", listed("skills"), listed("emails"), listed("phone_numbers"), F.concat_ws(";", *mentions).alias("entities")
    )


@register
def tokenize_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", "text")
    return terms.tokenize(docs, "text", TEST_STOP_WORDS).select("doc_id", listed("tokens"))


# --- posting and offer columns ------------------------------------------------------------


@register
def experience_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.salary_features(spark, sf_dir).select("job_id", "experience_numeric")


@register
def skill_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.part_requests(spark, sf_dir).select("request_id", rules.skill_count(F.col("listed")).alias("skill_count"))


@register
def salary_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.postings(spark, sf_dir).where(rules.has_salary(F.col("salary_min"), F.col("salary_max")))
    mid = rules.salary_midpoint(F.col("salary_min"), F.col("salary_max"))
    return rows.select("job_id", F.round(mid, 4).alias("salary_midpoint"))


@register
def salary_diff_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.offers(spark, sf_dir).select("offer_id", r6("salary_diff_percentage"))


@register
def rule_salary_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.part_requests(spark, sf_dir).select(
        "request_id", rules.rule_salary(F.col("skills"), F.col("years"), F.col("location")).alias("s")
    )
    return rows.select(
        "request_id",
        F.round("s.salary_min", 4).alias("salary_min"),
        F.round("s.salary_max", 4).alias("salary_max"),
        F.col("s.currency").alias("currency"),
    )


@register
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "part").select(
        "p_partkey", F.explode(F.array(F.replace("p_brand", F.lit("Brand#"), F.lit("")), F.col("p_type"))).alias("raw")
    )
    return splits.drop_nulls(raw.withColumn("number", rules.to_number(F.col("raw"))), ["number"])


@register
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.drop_nulls(views.jobs(spark, sf_dir), ["title", "embedding"]).select("job_id", "title")


@register
def threshold_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.offers(spark, sf_dir).select("offer_id", rules.threshold_label(F.col("match_score")).alias("label"))


# --- features -----------------------------------------------------------------------------


@register
def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF with the classifier's limits, learnt from the train rows and applied to all."""
    docs = splits.hash_split(views.documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    out = terms.tfidf(
        docs, "doc_id", "text", TEST_STOP_WORDS, bigrams=True, min_df=2, max_df=0.95, fit_where=F.col("is_train")
    )
    return out.select("doc_id", "term", "tf", "df", r6("idf"), r6("tfidf"))


@register
def tfidf_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", "text")
    out = terms.tfidf(docs, "doc_id", "text", TEST_STOP_WORDS, bigrams=False, min_df=5, max_df=0.7, max_features=1000)
    return out.select("doc_id", "term", "tf", "df", r6("idf"), r6("tfidf"))


@register
def embed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("text"))
    model = features.fit_hashed_embedder(docs, "text", stop_words=TEST_STOP_WORDS)
    out = features.embed_texts(docs, "text", model)
    return out.select("doc_id", F.size("embedding").alias("dim"), F.round(norm(F.col("embedding")), 6).alias("length"))


@register
def embed_by_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained word vectors, averaged per document: dimension and length of each."""
    docs = views.documents(spark, sf_dir)
    model = features.fit_word_embedder(docs, "text", dim=64, stop_words=TEST_STOP_WORDS, partitions=8)
    out = features.embed_by_words(docs, "doc_id", "text", model)
    return out.select("doc_id", F.size("embedding").alias("dim"), F.round(norm(F.col("embedding")), 6).alias("length"))


@register
def hashed_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component of every text's hashed vector."""
    out = features.hashed_components(views.documents(spark, sf_dir), "doc_id", "text", stop_words=TEST_STOP_WORDS)
    return out.select("doc_id", "slot", r6("value"))


@register
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.salary_features(spark, sf_dir).select("job_id", "experience_numeric", "salary_midpoint")
    out = features.standard_scale(rows, ["experience_numeric", "salary_midpoint"])
    return out.select("job_id", r6("experience_numeric_scaled"), r6("salary_midpoint_scaled"))


@register
def standard_scale_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    out = features.standard_scale_vector(rows, "embedding", "scaled")
    long = out.select("vec_id", F.posexplode("scaled").alias("dim", "value"))
    return long.select("vec_id", "dim", F.round("value", 5).alias("value"))


@register
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots known from the train rows; locations first seen in the test rows get none."""
    rows = splits.hash_split(views.salary_features(spark, sf_dir), "job_id")
    return features.one_hot(rows, "job_id", "location", rows.where("is_train"))


# --- matching -----------------------------------------------------------------------------


@register
def keyword_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    return matching.score_pairs(views.applications(spark, sf_dir), left, right).select("resume_id", "job_id", r6("keyword"))


@register
def keyword_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of rows that share at least a quarter of their skills, found through the rarest ones."""
    left, right = views.matching_sides(spark, sf_dir)
    return skill_join.keyword_pairs(left, right, 0.25).select("resume_id", "job_id", r6("keyword"))


@register
def keyword_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    return skill_join.keyword_pairs(left, right, 0.1, best=5).select("resume_id", "job_id", r6("keyword"), "rank")


@register
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    return matching.score_pairs(views.applications(spark, sf_dir), left, right).select("resume_id", "job_id", r6("cosine"))


@register
def combined_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    scored = matching.score_pairs(views.applications(spark, sf_dir), left, right)
    return scored.select("resume_id", "job_id", *[r6(c) for c in matching.SCORE_COLUMNS])


@register
def pair_matcher(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matcher trained on who was hired, then used in place of the proxy score."""
    # The fit and the scores pass over the pairs several times: the events are read once, and of the texts only those of the pairs, once.
    pairs = written(views.applications(spark, sf_dir), "pairs")
    sides = zip(views.matching_sides(spark, sf_dir), ("resume_id", "job_id"), strict=True)
    left, right = (written(side.join(pairs.select(c).distinct(), c, "left_semi").select(c, "embedding", "skills"), "side") for side, c in sides)
    rows = matching.pair_features(pairs, left, right)
    model = matching.fit_pair_matcher(rows, "hired")
    learned = matching.learned_scores(model, rows).select("resume_id", "job_id", "learned_score")
    return matching.score_pairs(learned, left, right, learned_col="learned_score").select(
        "resume_id", "job_id", *[r6(c) for c in matching.SCORE_COLUMNS]
    )


@register
def match_one_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    first = left.orderBy("resume_id").limit(1)
    return matching.match_one_resume(first, right).select("resume_id", "job_id", *[r6(c) for c in matching.SCORE_COLUMNS])


@register
def match_all_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    best = matching.match_all_topk(left, right, 5)
    return best.select("resume_id", "job_id", *[r6(c) for c in matching.SCORE_COLUMNS], "rank")


@register
def match_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the grid of tiles and pairs the bounds let the best matches skip."""
    left, right = views.matching_sides(spark, sf_dir)
    _, report = matching.best_matches(left, right, 5, rows_per_cell=matching.ROWS_PER_CELL)
    return _metric_row(spark, vars(report) | {"skipped_tiles": 1 - report.scored_tiles / max(report.tiles, 1), "skipped_pairs": 1 - report.scored_pairs / max(report.pairs, 1)})


@register
def all_scores_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    return matching.all_scores_histogram(left, right).select("bin", r6("low"), r6("high"), "n")


# --- splits, models -----------------------------------------------------------------------


@register
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.hash_split(views.postings(spark, sf_dir), "job_id").select("job_id", "is_train")


@register
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", "lang")
    return splits.stratified_split(docs, "lang", "doc_id", 0.8)


@register
def half_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.half_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@register
def half_split_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a string key."""
    keys = table(spark, sf_dir, "orders").select(F.concat(F.lit("job"), F.col("o_orderkey").cast("string")).alias("job_id"))
    return splits.half_split(keys, "job_id")


@register
def balanced_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = splits.balanced_weights(views.documents(spark, sf_dir).select("lang"), "lang")
    return out.select("lang", "n", r6("weight"))


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir).select(
        "doc_id", text.clean_text(F.col("text")).alias("cleaned_description"), F.col("lang").alias("job_category")
    )


def _metric_row(spark: SparkSession, found: dict) -> DataFrame:
    rows = [(k, float(v)) for k, v in sorted(found.items()) if v is not None]
    return views.literal_rows(spark, ("metric", "value"), rows)


@register
def train_job_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = models.train_job_classifier(_categories(spark, sf_dir), "doc_id", stop_words=TEST_STOP_WORDS)
    return trained.tables["report"]


@register
def predict_job_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows only, scored with the saved model."""
    docs, path = _categories(spark, sf_dir), new_scratch_path(spark, "category")
    trained = models.train_job_classifier(docs, "doc_id", path=path, stop_words=TEST_STOP_WORDS)
    # scoring passes over the test rows twice; the texts of the others are moved once, for the join
    test = written(docs.join(trained.tables["test"].select("doc_id"), "doc_id", "left_semi"), "test-rows")
    return models.predict_job_category(test, path=path).select("doc_id", "predicted_category")


@register
def train_salary_forecaster(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = models.train_salary_forecaster(views.salary_features(spark, sf_dir), "job_id")
    return _metric_row(spark, trained.metrics)


@register
def predict_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows only, scored with the saved model."""
    rows, path = views.salary_features(spark, sf_dir), new_scratch_path(spark, "salary")
    trained = models.train_salary_forecaster(rows, "job_id", path=path)
    test = rows.join(trained.tables["test"].select("job_id"), "job_id", "left_semi")
    return models.predict_salary(test, path=path).select("job_id", r6("predicted_salary"))


@register
def train_acceptance_predictor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_row(spark, models.train_acceptance_predictor(views.offers(spark, sf_dir), "offer_id").metrics)


@register
def predict_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows only, scored with the saved model."""
    rows, path = views.offers(spark, sf_dir), new_scratch_path(spark, "acceptance")
    trained = models.train_acceptance_predictor(rows, "offer_id", path=path)
    test = rows.join(trained.tables["test"].select("offer_id"), "offer_id", "left_semi")
    return models.predict_acceptance(test, path=path).select("offer_id", r6("acceptance_probability"))


def _clustered(spark: SparkSession, sf_dir: str, feature_type: str) -> DataFrame:
    """All jobs; their texts are embedded, so that no job lacks a vector."""
    column = "embedding" if feature_type == "embeddings" else "description"
    rows = views.jobs(spark, sf_dir).select("job_id", F.coalesce("description", F.lit("")).alias("description"))
    if feature_type == "embeddings":
        cleaned = rows.select("job_id", text.clean_text(F.col("description")).alias("cleaned"))
        model = features.fit_hashed_embedder(cleaned, "cleaned", dim=64, stop_words=TEST_STOP_WORDS)
        rows = written(features.embed_texts(cleaned, "cleaned", model).select("job_id", "embedding"), "job-vectors")
    _, out = segments.cluster_jobs(rows, column, 5, feature_type, stop_words=TEST_STOP_WORDS)
    return out


@register
def cluster_jobs_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir, "embeddings").select("job_id", "cluster")


@register
def cluster_jobs_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir, "tfidf").select("job_id", "cluster")


@register
def assign_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return segments.assign_clusters(vectors, "vec_id", "embedding", segments.centroids_of(vectors, "embedding", "label"))


@register
def market_segments_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, _ = segments.project_2d(_clustered(spark, sf_dir, "embeddings"))
    return points.select("job_id", "cluster", r6("x"), r6("y"))


# --- recommendation -----------------------------------------------------------------------


@register
def recommend_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = views.with_skills(views.jobs(spark, sf_dir), "description")
    out = recommend.recommend_content(views.resumes(spark, sf_dir), jobs, 3, vocabulary=TEST_SKILLS)
    return out.select("resume_id", "job_id", r6("score"), "rank")


@register
def recommend_content_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in, recommendations out: the vectors are made here."""
    jobs = views.with_skills(views.jobs(spark, sf_dir), "description").drop("embedding")
    resumes = views.resumes(spark, sf_dir).drop("embedding")
    out = recommend.recommend_content_from_text(resumes, jobs, 3, TEST_SKILLS, TEST_STOP_WORDS)
    return out.select("resume_id", "job_id", r6("score"), "rank")


@register
def recommend_cosine_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = views.matching_sides(spark, sf_dir)
    out = recommend.recommend_by_cosine(left, right, 5)
    return out.select("resume_id", "job_id", r6("match_score"), "rank", "title", "description", listed("skills"))


@register
def recommend_collaborative(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recommend.recommend_collaborative(views.interactions(spark, sf_dir), n=5)
    return out.select("user_id", "item_id", r6("score"), "rank")


@register
def recommend_als(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = recommend.fit_als(views.interactions(spark, sf_dir))
    return recommend.recommend_als(model, 5)


@register
def recommend_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users are resumes of the same id: their content matches first, then what their peers used."""
    n = 5
    jobs = views.with_skills(views.jobs(spark, sf_dir), "description")
    content = recommend.recommend_content(views.resumes(spark, sf_dir), jobs, 2 * n, vocabulary=TEST_SKILLS)
    content = content.select(F.col("resume_id").alias("user_id"), F.col("job_id").alias("item_id"), "rank")
    peers = recommend.recommend_collaborative(views.interactions(spark, sf_dir), n=2 * n)
    return recommend.recommend_hybrid(content, peers, n)


@register
def recommend_cold_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return recommend.recommend_cold_start(users, views.interactions(spark, sf_dir), 5)


# --- trends -------------------------------------------------------------------------------


@register
def skill_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.skill_trends(views.posting_skill_rows(spark, sf_dir), "date_posted")


@register
def first_period_top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.first_period_top_skills(trends.skill_trends(views.posting_skill_rows(spark, sf_dir), "date_posted"))


@register
def demand_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.demand_trends(table(spark, sf_dir, "orders"), "o_orderdate")


@register
def skill_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.skill_frequency(views.posting_skill_rows(spark, sf_dir), n=10)


@register
def cluster_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir).select("doc_id", "text", F.col("lang").alias("cluster"))
    return terms.cluster_top_terms(docs, "doc_id", "text", "cluster", 10, stop_words=TEST_STOP_WORDS)


@register
def avg_salary_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trends.avg_salary_by_title(views.salary_features(spark, sf_dir), "title", "salary_midpoint")
    return out.select("title", "postings", F.round("avg_salary", 4).alias("avg_salary"))


@register
def salary_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trends.salary_distribution(views.salary_features(spark, sf_dir), "title", "salary_midpoint")
    numbers = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return out.select("title", "n", *[F.round(c, 4).alias(c) for c in numbers], "outliers")


@register
def match_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trends.score_histogram(table(spark, sf_dir, "events"), "value", 20)
    return out.select("bin", r6("low"), r6("high"), "n")


@register
def match_score_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trends.score_density(table(spark, sf_dir, "events"), "value", 200)
    return out.select("point", r6("x"), F.round("density", 9).alias("density"))


@register
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.class_distribution(views.documents(spark, sf_dir), "lang")


@register
def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.cluster_sizes(table(spark, sf_dir, "embeddings"), "label")


# --- evaluation ---------------------------------------------------------------------------


@register
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    guesses = views.language_guesses(spark, sf_dir)
    out = None
    for average in metrics.AVERAGES:
        one = metrics.classification_metrics(guesses, "actual", "predicted", average, positive="en")
        out = one if out is None else out.unionByName(one)
    return out.select("average", *[r6(c) for c in ("accuracy", "precision", "recall", "f1_score")])


@register
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.classification_report(views.language_guesses(spark, sf_dir), "actual", "predicted")
    return out.select("label", *[r6(c) for c in ("precision", "recall", "f1_score")], "support")


@register
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(views.language_guesses(spark, sf_dir), "actual", "predicted")


@register
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.roc_auc(views.purchase_scores(spark, sf_dir), "label", "score")
    return out.select("positives", "negatives", r6("auc"))


@register
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.regression_metrics(views.title_means(spark, sf_dir), "salary_midpoint", "predicted")
    return out.select(F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"))


@register
def r2_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.r2_mae(views.title_means(spark, sf_dir), "salary_midpoint", "predicted")
    return out.select(r6("r2"), F.round("mae", 4).alias("mae"))


@register
def ranking_metrics_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users clicked most, held against what they bought; users who bought nothing count as 0."""
    clicks = views.event_items(spark, sf_dir, "click").groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    order = F.row_number().over(
        recommend.Window.partitionBy("user_id").orderBy(F.desc("n"), "item_id")
    )
    recs = clicks.withColumn("rank", order).where(F.col("rank") <= 10)
    bought = views.event_items(spark, sf_dir, "purchase").select("user_id", "item_id")
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    out = metrics.ranking_metrics_at_k(recs, users.join(bought, "user_id", "left"), (5, 10))
    return out.select("k", "users", r6("avg_precision"), r6("avg_recall"))


@register
def actual_vs_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual = views.salary_features(spark, sf_dir).select("job_id", "salary_midpoint")
    predicted = views.title_means(spark, sf_dir).select("job_id", "predicted")
    out = metrics.actual_vs_predicted(actual, predicted, "job_id", "salary_midpoint", "predicted")
    return out.select("job_id", F.round("salary_midpoint", 4).alias("salary_midpoint"), F.round("predicted", 4).alias("predicted"))


