from __future__ import annotations

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from jobweave.functions.text import clean_text, match_terms
from jobweave.operators.features import embed_texts, fit_hashed_embedder
from jobweave.sources import documents, postings
from jobweave.streaming.resumes import start_scoring_stream

NAMESPACE = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def write_docx(path, paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{NAMESPACE}"><w:body>{body}</w:body></w:document>')


@pytest.fixture
def folder(new_dir):
    def put(name, content):
        with open(os.path.join(new_dir, name), "wb") as f:
            f.write(content)

    put("a b%20.txt", "Élan python".encode())
    put("UPPER.TXT", b"java")
    put("cut.json", b'{"job_id": "jo')
    put("posting.json", json.dumps({"job_id": "job001"}).encode())
    put("empty.txt", b"")
    put("bad.txt", b"ok \xff\xfe text")
    put("image.png", b"\x89PNG")
    put("paper.pdf", b"%PDF")
    put("notes.xyz", b"?")
    put("broken.docx", b"not a zip")
    write_docx(os.path.join(new_dir, "cv.docx"), ["John Doe", "Software Engineer"])
    write_docx(os.path.join(new_dir, "blank.docx"), [])
    os.mkdir(os.path.join(new_dir, "nested"))
    put("nested/inner.txt", b"not read")
    return new_dir


def test_ingest_a_folder(spark, folder):
    good, aside = documents.ingest_documents(spark, folder)
    content = {r["file_name"]: r["raw_content"] for r in good.collect()}
    assert set(content) == {"a b%20.txt", "UPPER.TXT", "posting.json", "cv.docx"}
    assert content["cv.docx"] == "John Doe\nSoftware Engineer\n"
    assert content["a b%20.txt"] == "Élan python"
    problems = {r["file_name"]: r["problem"] for r in aside.collect()}
    assert problems == {
        "blank.docx": "empty", "image.png": "no extractor", "paper.pdf": "no extractor", "notes.xyz": "unsupported",
        "broken.docx": "unreadable: BadZipFile", "bad.txt": "undecodable", "cut.json": "malformed JSON",
    }


def test_ingest_one_file_bad_path_and_plugged_in_extractor(spark, folder):
    good, _ = documents.ingest_documents(spark, os.path.join(folder, "UPPER.TXT"))
    assert [r["raw_content"] for r in good.collect()] == ["java"]
    good, aside = documents.ingest_documents(spark, os.path.join(folder, "missing"))
    assert good.count() == 0 and aside.count() == 0
    registry = {**documents.DEFAULT_EXTRACTORS, ".pdf": lambda content: content.decode()}
    good, _ = documents.ingest_documents(spark, folder, registry)
    assert good.where("file_name = 'paper.pdf'").first()["raw_content"] == "%PDF"


def test_postings_round_trip_and_malformed_files(spark, new_dir):
    rows = [
        {"job_id": "job001", "title": "Dev", "skills_required": ["python"], "salary_min": 1, "experience_level": "Senior"},
        {"job_id": "job002", "requirements": ["sql"], "company": "X"},
    ]
    source = os.path.join(new_dir, "in")
    os.mkdir(source)
    for i, row in enumerate(rows):
        with open(os.path.join(source, f"job{i}.json"), "w") as f:
            json.dump(row, f, indent=2)
    with open(os.path.join(source, "broken.json"), "w") as f:
        f.write('{"job_id": ')
    good, bad = postings.read_job_postings(spark, source)
    assert {r["job_id"]: (r["skills_required"], r["salary_min"]) for r in good.collect()} == {
        "job001": (["python"], 1.0), "job002": (None, None),
    }
    assert bad.count() == 1
    out = os.path.join(new_dir, "out")
    postings.write_job_postings(good.drop("source_path").coalesce(1), out, one_document_per_file=True)
    assert len([f for f in os.listdir(out) if f.endswith(".json")]) == 2
    again, _ = postings.read_job_postings(spark, out)
    columns = [c for c in again.columns if c != "source_path"]
    assert sorted(map(repr, again.select(columns).collect())) == sorted(map(repr, good.select(columns).collect()))


def test_stream_scores_each_file_once(spark, folder):
    inbox, output, checkpoint = folder, folder + "-out", folder + "-checkpoint"
    texts = [("job1", "python developer with elan"), ("job2", "java engineer"), ("job3", "cook")]
    jobs = spark.createDataFrame(texts, "job_id string, description string")
    jobs = jobs.withColumn("cleaned", clean_text(F.col("description")))
    model = fit_hashed_embedder(jobs, "cleaned", stop_words=[])
    jobs = embed_texts(jobs, "cleaned", model).withColumn("skills", match_terms(F.col("cleaned"), ["python", "java"]))

    def run():
        start_scoring_stream(spark, inbox, jobs, model, output, checkpoint, n=2, vocabulary=["python", "java"]).awaitTermination(120)
        return spark.read.parquet(output + "/matches")

    best = {r["file_name"]: r["job_id"] for r in run().where("rank = 1").collect()}
    assert best["a b%20.txt"] == "job1" and best["UPPER.TXT"] == "job2"
    assert spark.read.parquet(output + "/set_aside").count() == 7
    first = spark.read.parquet(output + "/matches").count()
    with open(os.path.join(inbox, "late.txt"), "w") as f:
        f.write("java")
    out = run()
    assert out.count() == first + 2
    assert out.where("file_name = 'late.txt' and rank = 1").first()["job_id"] == "job2"
    assert out.where("file_name = 'UPPER.TXT'").first()["preview"] == "java"
