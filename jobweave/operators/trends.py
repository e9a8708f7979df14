"""Market aggregates: skills, demand, salaries, score distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.operators.joins import salted_join
from jobweave.operators.ranking import quantiles


def to_date(value: Column) -> Column:
    """The date of a timestamp, date or string; null when it cannot be read."""
    return value.try_cast("date")


def posting_skills(df: DataFrame, skills_col: str, keep: Sequence[str]) -> DataFrame:
    """List form to rows ``keep..., skill``; null lists give no row, duplicates stay."""
    return df.select(*keep, F.explode(skills_col).alias("skill"))


def skill_trends(df: DataFrame, date_col: str, skill_col: str = "skill") -> DataFrame:
    """Uses of each lower-cased skill per month: ``period, skill, count``. Takes one row per use."""
    period = F.date_format(to_date(F.col(date_col)), "yyyy-MM")
    rows = df.select(period.alias("period"), F.lower(skill_col).alias("skill"))
    return rows.dropna().groupBy("period", "skill").agg(F.count("*").alias("count"))


def first_period_top_skills(trends: DataFrame, n: int = 5) -> DataFrame:
    first = trends.agg(F.min("period")).scalar()
    return trends.where(F.col("period") == first).orderBy(F.desc("count"), "skill").limit(n)


def demand_trends(df: DataFrame, date_col: str) -> DataFrame:
    """Postings per month, months without any included as 0: ``period, postings``."""
    month = F.trunc(to_date(F.col(date_col)), "month")
    counts = df.select(month.alias("month")).where(F.col("month").isNotNull()).groupBy("month").agg(
        F.count("*").alias("postings")
    )
    months = counts.agg(
        F.expr("sequence(min(month), max(month), interval 1 month)").alias("s")
    ).select(F.explode("s").alias("month"))
    return months.join(counts, "month", "left").select(
        F.date_format("month", "yyyy-MM").alias("period"), F.coalesce("postings", F.lit(0)).alias("postings")
    )


def skill_frequency(df: DataFrame, skill_col: str = "skill", n: int = 20) -> DataFrame:
    """The ``n`` most frequent skills, ties by name: ``skill, count``."""
    counts = df.where(F.col(skill_col).isNotNull()).groupBy(F.col(skill_col).alias("skill")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "skill").limit(n)


def _numeric_salaries(df: DataFrame, title_col: str, salary_col: str) -> DataFrame:
    return df.select(
        F.col(title_col).alias("title"), F.col(salary_col).try_cast("double").alias("salary")
    ).dropna()


def avg_salary_by_title(df: DataFrame, title_col: str, salary_col: str) -> DataFrame:
    """``title, postings, avg_salary``, highest first."""
    means = _numeric_salaries(df, title_col, salary_col).groupBy("title").agg(
        F.count("*").alias("postings"), F.avg("salary").alias("avg_salary")
    )
    return means.orderBy(F.desc("avg_salary"), "title")


def salary_distribution(df: DataFrame, title_col: str, salary_col: str, buckets: int | None = None) -> DataFrame:
    """Box statistics per title, highest median first. Quartiles are exact.

    ``title, n, q1, median, q3, whisker_low, whisker_high, outliers``: whiskers end at the
    last values within 1.5 interquartile ranges of the box.
    """
    salaries = _numeric_salaries(df, title_col, salary_col)
    box = quantiles(salaries, "salary", [0.25, 0.5, 0.75], ["title"], buckets).select(
        "title", "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("salary") >= F.col("q1") - reach) & (F.col("salary") <= F.col("q3") + reach)
    counts = salaries.groupBy("title", "salary").agg(F.count("*").alias("c"))
    stats = salted_join(counts, box, "title", ["salary"]).groupBy("title", "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("salary"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("salary"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("c"))).alias("outliers"),
    )
    return stats.orderBy(F.desc("median"), "title")


def score_histogram(df: DataFrame, score_col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over the range of the scores, the last one closed: ``bin, low, high, n``.

    When all scores are equal the range is one unit wide around them.
    """
    scores = df.select(F.col(score_col).cast("double").alias("x")).where(F.col("x").isNotNull())
    ends = scores.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("e")).select(
        F.when(F.col("e.lo") == F.col("e.hi"), F.struct((F.col("e.lo") - 0.5).alias("lo"), (F.col("e.hi") + 0.5).alias("hi")))
        .otherwise(F.col("e"))
        .alias("e")
    )
    edge = ends.scalar()
    low = edge.getField("lo")
    width = (edge.getField("hi") - low) / bins
    counts = (
        scores.select(F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    grid = ends.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        F.col("e.lo").alias("lo"),
        ((F.col("e.hi") - F.col("e.lo")) / bins).alias("w"),
    )
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("w")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def score_density(df: DataFrame, score_col: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid over the range of the scores: ``point, x, density``.

    The bandwidth is Scott's ``n^(-1/5)`` times the sample deviation. Each distinct score
    contributes once, weighted by its count; the sums over it combine before the shuffle.
    """
    counts = (
        df.select(F.col(score_col).cast("double").alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count("*").alias("c"))
    )
    stats = df.select(F.col(score_col).cast("double").alias("v")).agg(
        F.struct(
            F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"), F.stddev_samp("v").alias("sd")
        )
    ).scalar()
    step = (stats.getField("hi") - stats.getField("lo")) / (points - 1)
    bandwidth = stats.getField("sd") * F.pow(stats.getField("n"), F.lit(-0.2))
    spread = counts.select(
        "v", "c", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).select("c", "point", ((stats.getField("lo") + F.col("point") * step - F.col("v")) / bandwidth).alias("z"))
    sums = spread.groupBy("point").agg(F.sum(F.col("c") * F.exp(F.col("z") * F.col("z") * -0.5)).alias("s"))
    scale = bandwidth * stats.getField("n") * F.lit(math.sqrt(2 * math.pi))
    return sums.select(
        "point", (stats.getField("lo") + F.col("point") * step).alias("x"), (F.col("s") / scale).alias("density")
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``label, n`` per class. The distinct labels are its rows, their number its row count."""
    return df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))


def cluster_sizes(df: DataFrame, cluster_col: str) -> DataFrame:
    return df.groupBy(F.col(cluster_col).alias("cluster")).agg(F.count("*").alias("members"))
