"""Training and scoring jobs: category, salary and offer-acceptance models."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizer,
    ElementwiseProduct,
    IDF,
    Normalizer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from jobweave.functions.rules import hash_percent, threshold_label
from jobweave.operators import metrics
from jobweave.operators.boosting import BoostedTrees, fit_boosted_trees
from jobweave.operators.features import token_stages
from jobweave.operators.newton import LogisticModel, fit_logistic
from jobweave.operators.slices import sliced, slices_of
from jobweave.operators.sparse_tree import TextTree, fit_sliced_tree
from jobweave.operators.splits import balanced_weights, check_training_rows, drop_nulls, hash_split, stratified_split
from jobweave.operators.terms import english_stop_words
from jobweave.session import written

# Where scoring looks for a model when it is given none. Training saves where it is told to.
CATEGORY_MODEL = "models/category"
SALARY_MODEL = "models/salary"
ACCEPTANCE_MODEL = "models/acceptance"


@dataclass
class Trained:
    """A fitted model, its scalar metrics, and its tables of test metrics (lazy)."""

    model: TextTree | BoostedTrees | LogisticModel
    metrics: dict[str, float]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    cached: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Give back the cached scores; the tables are computed anew if they are read after that."""
        for frame in self.cached:
            frame.unpersist()


def chain(stages: Iterable) -> PipelineModel:
    return PipelineModel(stages=list(stages))


def fit_tfidf_stages(
    df: DataFrame,
    text_col: str,
    out: str,
    stop_words: Sequence[str] | None = None,
    bigrams: bool = True,
    vocab_size: int | None = None,
    min_df: float = 1.0,
    max_df: float = 1.0,
) -> tuple[PipelineModel, list[str]]:
    """Fitted TF-IDF stages and the names of their scratch columns.

    Without ``vocab_size`` every term within the limits of document frequency is kept. The vocabulary is part of the model and lies
    on the driver, so bound the rows that a model is fitted on.

    Spark's IDF is ``ln((n+1)/(df+1))``; adding 1 to its weights gives the smoothed form of
    :func:`jobweave.operators.terms.smoothed_idf`, followed by the unit row norm.
    """
    tokens = token_stages(text_col, "_tokens", stop_words, bigrams)
    size = vocab_size or max(1, _terms_within(df, tokens, min_df, max_df))
    counter = CountVectorizer(inputCol="_tokens", outputCol="_counts", vocabSize=size, minDF=min_df, maxDF=max_df)
    counts = Pipeline(stages=[*tokens, counter, IDF(inputCol="_counts", outputCol="_idf")]).fit(df)
    weights = counts.stages[-1].idf.toArray() + 1.0
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighted")
    unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=out)
    scratch = ["_words", "_kept", "_tokens", "_counts", "_weighted"] + (["_pairs"] if bigrams else [])
    return chain([*counts.stages[:-1], weigh, unit]), scratch


def _terms_within(df: DataFrame, tokens: Sequence, min_df: float, max_df: float) -> int:
    """The number of terms whose document frequency is within the limits (shares below 1, else numbers of documents)."""
    rows = df.count()
    low, high = (x * rows if x < 1 else x for x in (min_df, max_df))
    split = chain(tokens).transform(df).select(F.explode(F.array_distinct("_tokens")).alias("term"))
    return split.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n").between(low, high)).count()


def _one_row(df: DataFrame) -> dict:
    return df.first().asDict()


# --- category -----------------------------------------------------------------------------


def train_job_classifier(
    df: DataFrame,
    id_col: str,
    text_col: str = "cleaned_description",
    label_col: str = "job_category",
    path: str | None = None,
    stop_words: Sequence[str] | None = None,
    max_depth: int = 30,
) -> Trained:
    """TF-IDF and a class-balanced decision tree on an 80/20 stratified split; ``id_col`` is unique.

    TF-IDF is fitted on the train rows only, with every term of two documents or more and at most 95 % of them. All train rows
    are fitted on: the tree is grown on sparse rows (:mod:`jobweave.operators.sparse_tree`), so nothing grows with texts times terms.
    """
    rows = drop_nulls(df, [id_col, text_col, label_col]).select(id_col, text_col, F.col(label_col).cast("string").alias(label_col))
    info = check_training_rows(rows, label_col, text=text_col)
    stops = list(english_stop_words(df.sparkSession) if stop_words is None else stop_words)
    slices = slices_of(info["bytes"])
    split = written(stratified_split(sliced(rows, [id_col, label_col], text_col, stops, slices), label_col, id_col, 0.8), "words-of-texts")
    check_training_rows(split.where("is_train"), label_col)
    model, found = fit_sliced_tree(split, slices, id_col, text_col, label_col, "is_train", stops, max_depth)
    scored = found.persist(StorageLevel.MEMORY_AND_DISK)
    accuracy = scored.groupBy("is_train").agg(F.avg((F.col(label_col) == F.col("predicted_category")).cast("double")).alias("a"))
    by_part = {r["is_train"]: r["a"] for r in accuracy.collect()}
    test = scored.where(~F.col("is_train"))
    if path:
        model.save(path)
    return Trained(
        model,
        {"train_accuracy": by_part.get(True), "test_accuracy": by_part.get(False), "rows": info["rows"]},
        {"report": metrics.classification_report(test, label_col, "predicted_category"), "test": test},
        [scored],
    )


def predict_job_category(df: DataFrame, model: TextTree | None = None, path: str = CATEGORY_MODEL) -> DataFrame:
    """``df`` with ``predicted_category``; empty in, empty out. Without a model the saved one is loaded."""
    return (TextTree.load(df.sparkSession, path) if model is None else model).transform(df)


# --- salary -------------------------------------------------------------------------------


def train_salary_forecaster(
    df: DataFrame,
    id_col: str,
    target: str = "salary_midpoint",
    path: str | None = None,
    numeric: Sequence[str] = ("experience_numeric",),
    categorical: Sequence[str] = ("location",),
    rounds: int = 100,
    min_rows: int = 10,
    patience: int = 10,
) -> Trained:
    """Numbers and one-hot categories into boosted trees: 100 rounds, rate 0.1, depth 5, stopped after ten flat rounds.

    Early stopping watches a tenth of the train rows and never the test rows; the model is that of the best round. Trees do not see the
    scale of a number, so numbers are binned as they are.
    """
    required = [id_col, *numeric, *categorical, target]
    rows = drop_nulls(df, required).select(required)
    check_training_rows(rows, min_rows=min_rows)
    split = hash_split(rows, id_col, 80).withColumn("_watch", hash_percent(F.concat(F.lit("watch"), F.col(id_col))) < 10)
    split = split.persist(StorageLevel.MEMORY_AND_DISK)
    model, stopped = fit_boosted_trees(split.where("is_train"), target, numeric, categorical, "_watch", "predicted_salary", rounds, patience=patience)
    scored = model.transform(split).select(id_col, target, "predicted_salary", "is_train").persist(StorageLevel.MEMORY_AND_DISK)
    found: dict[str, float] = dict(stopped)
    for name, part in (("train", scored.where("is_train")), ("test", scored.where(~F.col("is_train")))):
        gap = F.col(target).cast("double") - F.col("predicted_salary")
        r = part.agg(
            F.sqrt(F.avg(gap * gap)).alias("rmse"),
            (1 - F.try_divide(F.sum(gap * gap), F.var_pop(target) * F.count(target))).alias("r2"),
            F.avg(F.abs(gap)).alias("mae"),
        ).first()
        found |= {f"{name}_rmse": r["rmse"], f"{name}_r2": r["r2"]}
        if name == "test":
            found["test_mae"] = r["mae"]
    split.unpersist()
    if path:
        model.save(df.sparkSession, path)
    return Trained(model, found, {"test": scored.where(~F.col("is_train"))}, [scored])


def predict_salary(df: DataFrame, model: BoostedTrees | None = None, path: str = SALARY_MODEL) -> DataFrame:
    """``df`` with ``predicted_salary``; no rows is an error. Without a model the saved one is loaded."""
    if df.isEmpty():
        raise ValueError("no rows to score")
    return (BoostedTrees.load(df.sparkSession, path) if model is None else model).transform(df)


# --- offer acceptance ---------------------------------------------------------------------

ACCEPTANCE_NUMERIC = ("match_score", "salary_diff_percentage", "candidate_experience_years")
ACCEPTANCE_BINARY = ("is_remote",)


def train_acceptance_predictor(
    df: DataFrame,
    id_col: str,
    target: str = "accepted_offer",
    path: str | None = None,
    numeric: Sequence[str] = ACCEPTANCE_NUMERIC,
    binary: Sequence[str] = ACCEPTANCE_BINARY,
    inverse_penalty: float = 1.0,
    min_rows: int = 10,
) -> Trained:
    """Scaled numbers and 0/1 flags into a class-balanced L2 logistic regression, 75/25 stratified.

    Of the named features those present are used. The intercept is penalised like a coefficient, and the fit is Newton's
    (:mod:`jobweave.operators.newton`): under ten passes over the train rows.
    """
    numbers = [c for c in numeric if c in df.columns]
    flags = [c for c in binary if c in df.columns]
    if not numbers and not flags:
        raise ValueError("no known feature column present")
    required = [id_col, *numbers, *flags, target]
    rows = drop_nulls(df, required).select(required)
    check_training_rows(rows, target, min_rows=min_rows)
    split = stratified_split(rows, target, id_col, 0.75).persist(StorageLevel.MEMORY_AND_DISK)
    train = split.where("is_train")
    check_training_rows(train, target)
    weights = {int(r[target]): r["weight"] for r in balanced_weights(train, target).collect()}
    model = fit_logistic(train, target, numbers, flags, weights, inverse_penalty)
    scored = predict_acceptance(split, model).persist(StorageLevel.MEMORY_AND_DISK)
    labelled = scored.withColumn("predicted", threshold_label(F.col("acceptance_probability")))
    accuracy = labelled.groupBy("is_train").agg(F.avg((F.col(target) == F.col("predicted")).cast("double")).alias("a"))
    by_part = {r["is_train"]: r["a"] for r in accuracy.collect()}
    test = labelled.where(~F.col("is_train"))
    auc = _one_row(metrics.roc_auc(test, target, "acceptance_probability"))["auc"]
    split.unpersist()
    if path:
        model.save(df.sparkSession, path)
    return Trained(
        model,
        {"train_accuracy": by_part.get(True), "test_accuracy": by_part.get(False), "test_roc_auc": auc, "passes": float(model.passes)},
        {
            "report": metrics.classification_report(test, target, "predicted"),
            "confusion": metrics.confusion_matrix(test, target, "predicted"),
            "test": test,
        },
        [scored],
    )


def predict_acceptance(df: DataFrame, model: LogisticModel | None = None, path: str = ACCEPTANCE_MODEL) -> DataFrame:
    """``df`` with ``acceptance_probability``: the probability of class 1. Without a model the saved one is loaded."""
    return (LogisticModel.load(df.sparkSession, path) if model is None else model).transform(df)
