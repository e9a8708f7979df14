from __future__ import annotations

import random

from jobweave.plans.market_report import ReportInputs, run_report
from jobweave.sources.postings import POSTING_SCHEMA


def test_report_on_sample_postings(spark, new_dir):
    rng = random.Random(1)
    kinds = {
        "Python Developer": ("senior python developer aws microservices", ["python", "aws"], "Senior", 140000.0),
        "Frontend Developer": ("frontend react javascript html css", ["react", "css"], "Mid", 100000.0),
        "Data Analyst": ("entry level analyst sql excel", ["sql", "excel"], "Entry", 65000.0),
    }
    rows = []
    for i in range(90):
        title = list(kinds)[i % 3]
        text, skills, level, salary = kinds[title]
        words = text.split() + ["team"]
        rng.shuffle(words)
        rows.append((f"job{i:03d}", title, None, " ".join(words), skills, None, rng.choice(["Remote", "Austin"]), salary * 0.9, salary * 1.1, level))
    postings = spark.createDataFrame(rows, POSTING_SCHEMA)
    resumes = spark.createDataFrame(
        [("r1", "Python developer, AWS and Django."), ("r2", "SQL analyst with Excel")], "resume_id string, text string"
    )
    offers = spark.createDataFrame(
        [(i, rng.random(), float(i % 7 - 3), i % 5, int(i % 7 > 3)) for i in range(120)],
        "offer_id long, match_score double, salary_diff_percentage double, candidate_experience_years int, accepted_offer int",
    )
    used = spark.createDataFrame([("r1", "job001"), ("r2", "job001"), ("r2", "job004")], "user_id string, item_id string")
    paths = run_report(spark, ReportInputs(resumes, postings, offers, used), new_dir + "/out", stop_words=[])
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    best = {r["resume_id"]: r["job_id"] for r in tables["matches"].where("rank = 1").collect()}
    titles = {r[0]: r[1] for r in rows}
    assert titles[best["r1"]] == "Python Developer" and titles[best["r2"]] == "Data Analyst"
    assert tables["matches"].count() == 10
    assert sum(r["n"] for r in tables["match_histogram"].collect()) == 2 * 90
    assert tables["recommendations"].groupBy("user_id").count().collect() and tables["recommendations"].count() == 10
    shown = tables["salary_actual_vs_predicted"]
    assert 0 < shown.count() < 45 and shown.columns == ["job_id", "salary_midpoint", "predicted_salary"]
    assert tables["acceptance_predictions"].count() == 120 and tables["acceptance_report"].count() == 5
    assert [r["title"] for r in tables["salary_by_title"].collect()] == ["Python Developer", "Frontend Developer", "Data Analyst"]
    metrics = {r["metric"]: r["value"] for r in tables["salary_metrics"].collect()}
    assert metrics["test_r2"] > 0.9
    report = {r["label"]: r for r in tables["category_report"].collect()}
    assert report["accuracy"]["f1_score"] > 0.9
    assert tables["segments"].select("cluster").distinct().count() == 3
    assert tables["skill_frequency"].first()["count"] == 60
