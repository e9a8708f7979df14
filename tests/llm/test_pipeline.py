"""The pipeline's stages against plain versions, each on its own input."""

from __future__ import annotations

import random

import public_tokenizers
from conftest import SF_DIR
from llm import brute
from llm.conftest import prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from jobweave.llm.common import written


def test_registration():
    assert "pipeline" in queries() and "pipeline" not in oracle_sql()
    assert all(any(name.startswith(f"op{n}_") for name in queries()) for n in range(1, 11))


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    for rows in (odd_docs, no_docs):
        now = rows.select("doc_id", "text", "lang", "source", "n_chars", "bucket", "kept")
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF_DIR)
            assert now.count() <= rows.count()


def test_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    now, before = docs, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_DIR)
        assert now.columns == docs.columns, name
        after = {r["doc_id"]: r["text"] for r in now.collect()}
        rows = list(before.items())
        if name == "language identification":
            assert len(after) >= 0.97 * len(before) and all(any(map(str.isalpha, t)) for t in after.values())
        elif name == "n-gram Jaccard join":
            assert set(after) == {i for i, (_, c) in brute.components(rows, 5, 80).items() if i == c} and len(after) < len(before)
        elif name == "suffix-array dedup":
            want = brute.removed_bytes(rows)
            assert all(len(after.get(i, "").encode()) >= w[0] - w[1] for i, w in want.items())
            assert all(after[i] == t for i, t in rows if not want[i][1])
        else:
            assert set(after) == {i for i, w in brute.contamination(rows, items).items() if not w[1]} and len(after) < len(before)
        before = after
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in before.items()}
    assert {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == want


def test_near_copies_between_eight_and_nine_tenths(spark):
    """Copies that 3-word shingles at 0.9 would not link go; copies below 0.8 of 5-word shingles stay."""
    rng = random.Random(77)
    rows = []
    for group in range(12):
        words = prose(rng, 200).replace("\n", " ").split()
        for edits in (0, 2, 4, 8, 12):
            copy = list(words)
            for n in range(edits):
                copy[(n * 200) // max(edits, 1) + 7] = f"edit{group}x{edits}x{n}"
            rows.append((len(rows), " ".join(copy), "en", "s", None, "b", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bucket string, head long").repartition(4)
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF_DIR).collect()}
    texts = [(r[0], r[1]) for r in rows]
    want = {i for i, (_, c) in brute.components(texts, 5, 80).items() if i == c}
    assert kept == want and want < {i for i, (_, c) in brute.components(texts).items() if i == c} and len(want) > 12
    repeated = docs.unionByName(docs).unionByName(docs.withColumn("source", F.lit("other")))
    found = corpus_pipeline.keep_one_of_each_group(spark, repeated, SF_DIR).collect()
    assert {r["doc_id"] for r in found} == want and len(found) == len(want) and {r["source"] for r in found} == {"other"}


def test_texts_are_joined_with_places_and_spans_only(spark):
    """What follows a text through the cut goes with it: no third join, which would move the texts again."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    cut = corpus_pipeline.cut_repeats(spark, docs, SF_DIR)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def test_emptied_documents_go(spark):
    text = prose(random.Random(5), 100)
    rows = [(1, text), (2, text), (3, "\n\n" + text[:150]), (4, "\n \n")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.cut_repeats(spark, docs, SF_DIR).collect()] == [1]


def test_texts_that_share_an_id(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    shared = [prose(random.Random(200 + n), 70) for n in range(30)]
    more = spark.createDataFrame([(None if n % 2 else 5, t, "en", None, len(t)) for n, t in enumerate(shared)], rows.schema)
    labelled = spark.createDataFrame([(100 + n, prose(random.Random(300 + n), 70), "en", None, 1) for n in range(40)], rows.schema)
    now = rows.unionByName(more).unionByName(labelled)
    original = [r["text"] for r in odd_docs.where("doc_id = 1").collect()][0]
    want = sorted([original, *shared, *[r["text"] for r in labelled.collect()]])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, SF_DIR), "odd")
        assert sorted(r["text"] for r in now.where("text is not null").collect() if r["text"] != original + " end") == want or stage is corpus_pipeline.keep_languages
    assert sorted((r["doc_id"] or 0, r["text"]) for r in now.where("doc_id is null or doc_id < 100").collect()) == sorted(
        [(0, original), *[(0 if n % 2 else 5, t) for n, t in enumerate(shared)]]
    )
