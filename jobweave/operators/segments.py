"""Market segments: clustering of postings and a 2-D view of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.functions.vectors import as_doubles
from jobweave.operators.models import fit_tfidf_stages
from jobweave.session import written


def _at_most(df: DataFrame, k: int) -> int:
    """``k``, or the number of rows when there are fewer; no rows is an error."""
    rows = df.limit(k).count()
    if rows == 0:
        raise ValueError("no rows to cluster")
    return rows


def cluster_jobs(
    df: DataFrame,
    column: str,
    k: int = 5,
    feature_type: str = "embeddings",
    stop_words: Sequence[str] | None = None,
    seed: int = 42,
    **kmeans,
) -> tuple[PipelineModel, DataFrame]:
    """K-means segments of an embedding array column or, with ``'tfidf'``, of a text column.

    Returns the fitted pipeline and ``df`` with the columns ``features`` and ``cluster``.
    Embeddings are standardised per dimension; TF-IDF vectors (1000 terms) stay sparse. A null text counts as an empty one; rows without an
    embedding are not fitted on and come back with null in both columns.
    """
    if feature_type not in ("embeddings", "tfidf"):
        raise ValueError("feature_type must be 'embeddings' or 'tfidf'")
    without = None
    if feature_type == "embeddings":
        rows, without = df.where(F.col(column).isNotNull()), df.where(F.col(column).isNull())
    else:
        rows = df.withColumn(column, F.coalesce(F.col(column), F.lit("")))
    clusters = _at_most(rows, k)
    if feature_type == "embeddings":
        prepared = rows.withColumn("_vector", array_to_vector(as_doubles(F.col(column))))
        scaler = StandardScaler(withMean=True, withStd=True, inputCol="_vector", outputCol="features")
        head, scratch = Pipeline(stages=[scaler]).fit(prepared), ["_vector"]
    else:
        prepared = rows
        head, scratch = fit_tfidf_stages(
            prepared, column, "features", stop_words, bigrams=False, vocab_size=1000, min_df=5, max_df=0.7
        )
    # written once: every pass of the fit, and all that is done with the segments, reads vectors and not texts
    features = written(head.transform(prepared).drop(*scratch), "cluster-features")
    means = KMeans(k=clusters, seed=seed, featuresCol="features", predictionCol="cluster", **kmeans)
    fitted = means.fit(features)
    # Already fitted stages pass through; nothing is fitted twice.
    model = PipelineModel(stages=[*head.stages, fitted])
    labelled = fitted.transform(features)
    return model, labelled if without is None else labelled.unionByName(without, allowMissingColumns=True)


def assign_clusters(df: DataFrame, id_col: str, vector_col: str, centroids: DataFrame) -> DataFrame:
    """``id, cluster, distance`` to the nearest of the given centroids, ties by cluster number.

    ``centroids`` has the columns ``cluster`` and ``center``; its ``k`` rows travel as one array, so
    each point is assigned in its own row.
    """
    packed = centroids.agg(F.array_sort(F.collect_list(F.struct("cluster", "center")))).scalar()
    point = as_doubles(F.col(vector_col))

    def squared(center):
        parts = F.zip_with(point, center, lambda x, c: (x - c) * (x - c))
        return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)

    nearest = F.array_min(
        F.transform(
            F.col("_centroids"),
            lambda c: F.struct(F.round(F.sqrt(squared(c["center"])), 6).alias("distance"), c["cluster"].alias("cluster")),
        )
    )
    with_centroids = df.select(id_col, vector_col, packed.alias("_centroids"))
    return with_centroids.select(id_col, nearest.alias("_n")).select(id_col, F.col("_n.cluster").alias("cluster"), F.col("_n.distance").alias("distance"))


def centroids_of(df: DataFrame, vector_col: str, cluster_col: str) -> DataFrame:
    """Mean vector per cluster: ``cluster, center``."""
    sums = df.select(F.col(cluster_col).alias("cluster"), F.posexplode(vector_col).alias("d", "x"))
    means = sums.groupBy("cluster", "d").agg(F.avg("x").alias("m"))
    ordered = means.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("d", "m"))).alias("c"))
    return ordered.select("cluster", F.transform("c", lambda t: t["m"]).alias("center"))


def project_2d(df: DataFrame, features_col: str = "features") -> tuple[DataFrame, list[float]]:
    """``df`` with ``x`` and ``y``, and the share of variance each explains.

    Two dimensions are taken as they are, more are reduced by PCA on centred features, fewer are an
    error. The sign of a component is arbitrary.
    """
    first = df.select(F.size(vector_to_array(features_col)).alias("d")).first()
    dims = first["d"] if first else 0
    if dims < 2:
        raise ValueError("need at least two dimensions")
    if dims == 2:
        xy, shares = df.withColumn("_xy", vector_to_array(features_col)), [1.0]
    else:
        stages = [
            StandardScaler(withMean=True, withStd=False, inputCol=features_col, outputCol="_centred"),
            PCA(k=2, inputCol="_centred", outputCol="_pc"),
        ]
        model = Pipeline(stages=stages).fit(df)
        shares = [float(v) for v in model.stages[-1].explainedVariance.toArray()]
        xy = model.transform(df).withColumn("_xy", vector_to_array("_pc")).drop("_centred", "_pc")
    return xy.withColumns({"x": F.col("_xy")[0], "y": F.col("_xy")[1]}).drop("_xy"), shares
