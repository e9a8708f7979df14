from __future__ import annotations

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from jobweave.functions import fixed, rules, text
from jobweave.operators import tagging, terms
from jobweave.plans.catalog import QUERIES
from jobweave.plans.views import literal_rows


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(fn(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""),
        ("", ""),
        ("!!! ...", ""),
        ("Problem-Solving,  and\tMore\n\nlines ", "problem-solving and more lines"),
        ("C++ & C#", "c c"),
        ("Élève  Naïve", "élève naïve"),
        ("a\x1cb　c", "a b c"),
    ],
)
def test_clean_text(spark, raw, want):
    assert one(spark, raw, text.clean_text) == want


@pytest.mark.parametrize("raw", [None, "", " .,;\t\n", "\x1c\u3000[]^", "-", "a", "...é", "\\", "_"])
def test_has_content_agrees_with_cleaning(spark, raw):
    assert one(spark, raw, text.has_content) == (one(spark, raw, text.clean_text) != "")


def test_preview_cuts_only_long_texts(spark):
    assert one(spark, "x" * 200, text.preview) == "x" * 200
    assert one(spark, "x" * 201, text.preview) == "x" * 200 + "..."
    assert one(spark, None, text.preview) == ""
    assert one(spark, None, text.upload_preview) == "(no preview)"
    assert one(spark, "y" * 600, text.upload_preview) == "y" * 500


def test_contact_details(spark):
    note = "Write to mara.k@mail.example, or dial 415.733.2290 x 77; later mara.k@mail.example again"
    assert one(spark, note, text.extract_emails) == ["mara.k@mail.example", "mara.k@mail.example"]
    assert one(spark, note, text.extract_phone_numbers) == ["415.733.2290 x 77"]
    # An exchange starts with 2 to 9, and so does an area code.
    assert one(spark, "dial 415.033.2290", text.extract_phone_numbers) == []
    assert one(spark, "Oslo, (099) 733-2290", text.extract_phone_numbers) == ["733-2290"]
    assert one(spark, "no way to reach me", text.extract_emails) == []


def whole_word_skills(value, vocabulary):
    """The definition: one whole-word search per term."""
    return sorted({t.lower() for t in vocabulary if re.search(r"\b" + re.escape(t) + r"\b", value, re.IGNORECASE)})


SKILL_TEXTS = [
    "Python, java and JavaScript; big data analysis with scikit-learn",
    "data science data analysis machine learning deep learning",
    "aié and ai", "c++ c++x c", "power bi, power  bi", "", "restful services api apis",
    "natural language processing nlp naturallanguage", "excel_sheet excel",
]


def test_skills_equal_one_search_per_term(spark):
    frame = spark.createDataFrame([(t,) for t in SKILL_TEXTS], "t string")
    got = frame.select("t", text.match_terms(F.col("t"), fixed.DEFAULT_SKILLS).alias("s")).collect()
    for row in got:
        assert row["s"] == whole_word_skills(row["t"], fixed.DEFAULT_SKILLS), row["t"]


def test_overlapping_and_prefix_terms_all_count(spark):
    vocabulary = ["big", "big data", "big data analysis", "data", "data analysis", "analysis", "big-data"]
    for value in ["big data analysis", "big data analyst", "big-data", "bigdata analysis"]:
        assert one(spark, value, lambda c: text.match_terms(c, vocabulary)) == whole_word_skills(value, vocabulary)


def test_symbol_terms_need_the_symbol_aware_mode(spark):
    assert one(spark, "knows c++ well", lambda c: text.match_terms(c, ["c++", "c"])) == ["c"]
    assert one(spark, "knows c++ well", lambda c: text.match_terms(c, ["c++", "c"], symbol_aware=True)) == ["c", "c++"]


def test_table_form_equals_expression_form(spark):
    texts = spark.createDataFrame(list(enumerate(SKILL_TEXTS)), "id int, t string")
    vocabulary = [t for t in fixed.DEFAULT_SKILLS if t != "c++"]
    table = literal_rows(spark, ("term",), [(t,) for t in vocabulary])
    by_join = {}
    for r in tagging.match_vocabulary(texts, "id", "t", table).collect():
        by_join.setdefault(r["id"], []).append(r["skill"])
    for i, value in enumerate(SKILL_TEXTS):
        assert sorted(by_join.get(i, [])) == whole_word_skills(value, vocabulary)


def test_entities_keep_every_label_and_text_order(spark):
    texts = spark.createDataFrame([(1, "ada met bob in new york"), (2, ""), (3, None)], "id int, t string")
    gazetteer = literal_rows(
        spark, ("label", "phrase"), [("PERSON", "bob"), ("PERSON", "Ada"), ("GPE", "new york"), ("GPE", "york"), ("X", "met")]
    )
    got = {r["id"]: r["entities"] for r in tagging.tag_entities(texts, "id", "t", gazetteer).collect()}
    assert got[1]["PERSON"] == ["ada", "bob"]
    assert got[1]["GPE"] == ["new york", "york"]
    assert all(set(e) == set(fixed.ENTITY_LABELS) for e in got.values())
    assert all(v == [] for i in (2, 3) for v in got[i].values())


ODD_TEXTS = [
    "Ada met  Bob in New York, new york city; newyork new  york", "é ada ada's _ada ada_ ada-ada", "", None, "at&t at&t2 at &t", "NEW\nYORK new york",
    "a.b (a.b) a\\b x*y 2nd 𝔸da ʼn ada", "york new york new york city york",
]
ODD_GAZETTEER = [
    ("PERSON", "Ada"), ("PERSON", "ada"), ("ORG", "ADA"), ("GPE", "new york"), ("GPE", "New York City"), ("LOC", "york"), ("GPE", "york"), ("ORG", "new"),
    ("ORG", "at&t"), ("ORG", "a.b"), ("ORG", "a\\b"), ("DATE", "2nd"), ("DATE", "x*y"), ("PERSON", "𝔸da"), ("LOC", ""), ("LOC", None), ("LOC", "(a"), ("X", "met"),
]


def test_entities_by_pattern_and_by_join_are_the_same(spark, monkeypatch):
    texts = spark.createDataFrame([*enumerate(ODD_TEXTS), (None, "ada in new york")], "id int, t string")
    gazetteer = spark.createDataFrame(ODD_GAZETTEER, "label string, phrase string")
    vocabulary = gazetteer.select("phrase")

    def results(phrases):
        tagged = sorted((r["id"] is None, r["id"] or 0, sorted(r["entities"].items())) for r in tagging.tag_entities(texts, "id", "t", phrases).collect())
        record = sorted((r["id"], sorted(r["entities"].items())) for r in tagging.preprocess_with_entities(texts, "id", "t", phrases).collect())
        skills = sorted((str(r["id"]), r["skill"]) for r in tagging.match_vocabulary(texts, "id", "t", phrases, "phrase").collect())
        return tagged, record, skills

    by_pattern = results(gazetteer)
    assert tagging._pattern_rows(vocabulary, "phrase") is not None
    first = dict(by_pattern[0][0][2])
    assert first["GPE"] == ["new york", "york", "new york", "new york city", "york", "york"] and first["PERSON"] == ["ada", "ada"] and first["ORG"][:2] == ["ada", "new"]
    monkeypatch.setattr(tagging, "PATTERN_PHRASES", 0)
    assert tagging._pattern_rows(vocabulary, "phrase") is None
    assert results(gazetteer) == by_pattern


def test_texts_of_one_id_share_their_mentions(spark):
    """As in the SQL: one row for each text, with the mentions of all texts of its id, by place and phrase."""
    texts = spark.createDataFrame([(1, "ada met bob"), (1, "bob"), (2, "ada")], "id int, t string")
    gazetteer = literal_rows(spark, ("label", "phrase"), [("PERSON", "bob"), ("PERSON", "ada")])
    for frame in (tagging.tag_entities(texts, "id", "t", gazetteer), tagging.preprocess_with_entities(texts, "id", "t", gazetteer)):
        got = sorted((r["id"], r["entities"]["PERSON"]) for r in frame.collect())
        assert got == [(1, ["ada", "bob", "bob"]), (1, ["ada", "bob", "bob"]), (2, ["ada"])]


def test_phrases_for_no_pattern_are_joined(spark):
    """A phrase that ends in a symbol, a very long one, a large table."""
    assert tagging._pattern_rows(literal_rows(spark, ("p",), [("c++",), ("java",)]), "p") is None
    assert tagging._pattern_rows(literal_rows(spark, ("p",), [("a" * (tagging.PATTERN_CHARS + 1),)]), "p") is None
    many = spark.range(tagging.PATTERN_PHRASES + 1).select(F.concat(F.lit("w"), F.col("id")).alias("p"))
    assert tagging._pattern_rows(many, "p") is None and len(tagging._pattern_rows(many.limit(9), "p")) == 9
    texts = spark.createDataFrame([(1, "java and w7 c++")], "id int, t string")
    assert {r["skill"] for r in tagging.match_vocabulary(texts, "id", "t", many, "p").collect()} == {"w7"}


@pytest.mark.parametrize("name, searches", [("tag_entities", 1), ("preprocess_with_entities", 4), ("match_vocabulary", 1)])
def test_texts_are_searched_once_for_a_small_table(spark, name, searches):
    """One pattern search of each text, no row for each run of words."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == searches and "_gram" not in plan and "Join" not in plan


def test_preprocess_record_of_a_null_text(spark):
    frame = spark.createDataFrame([(1, None), (2, "Knows Python. a@b.io")], "id int, t string")
    gazetteer = literal_rows(spark, ("label", "phrase"), [("PRODUCT", "python")])
    rows = {r["id"]: r for r in tagging.preprocess_with_entities(frame, "id", "t", gazetteer).collect()}
    assert (rows[1]["cleaned_text"], rows[1]["skills"], rows[1]["emails"]) == ("", [], [])
    assert rows[2]["skills"] == ["python"] and rows[2]["entities"]["PRODUCT"] == ["python"]
    assert rows[2]["emails"] == ["a@b.io"] and rows[2]["original_text_preview"] == "Knows Python. a@b.io"


def test_tokens_and_bigrams(spark):
    frame = spark.createDataFrame([("The big Data of a Élan x1",)], "t string")
    got = terms.tokenize(frame, "t", ["the", "of"]).first()["tokens"]
    assert got == ["big", "data", "élan", "x1", "big data", "data élan", "élan x1"]
    single = spark.createDataFrame([("one",), ("",), (None,)], "t string")
    assert [r["tokens"] for r in terms.tokenize(single, "t", []).collect()] == [["one"], [], []]


def test_posting_rules(spark):
    rows = [("Senior", 100, 200), ("Mid-Senior", 0, 200), (None, None, 5)]
    frame = spark.createDataFrame(rows, "l string, a int, b int")
    got = frame.select(
        rules.experience_years(F.col("l")).alias("y"), rules.salary_midpoint(F.col("a"), F.col("b")).alias("m")
    ).collect()
    assert [(r["y"], r["m"]) for r in got] == [(5, 150.0), (2, None), (2, None)]


def test_rule_salary(spark):
    frame = spark.createDataFrame(
        [(["python", "aws", "api"], 5, "Remote"), (["x"], 0, "San Francisco, CA"), (None, 1, None)],
        "s array<string>, y int, l string",
    )
    got = frame.select(rules.rule_salary(F.col("s"), F.col("y"), F.col("l")).alias("r")).collect()
    want = [(93600.0, 114400.0), (42000 * 1.2 * 0.9, 42000 * 1.2 * 1.1), (45000.0, 55000.0)]
    for row, (low, high) in zip(got, want):
        assert row["r"]["salary_min"] == pytest.approx(low) and row["r"]["salary_max"] == pytest.approx(high)
        assert row["r"]["currency"] == "USD"


def test_small_rules(spark):
    frame = spark.createDataFrame([(["a"], None, "12.5", 0.5), (None, ["a", "b"], "x", 0.51)], "e array<string>, l array<string>, n string, p double")
    got = frame.select(
        rules.merge_skills(F.col("e"), F.col("l")).alias("m"),
        rules.skill_count(F.col("e")).alias("c"),
        rules.to_number(F.col("n")).alias("n"),
        rules.threshold_label(F.col("p")).alias("t"),
        rules.salary_diff_percentage(F.lit(110), F.lit(100)).alias("d"),
        rules.salary_diff_percentage(F.lit(110), F.lit(0)).alias("z"),
    ).collect()
    assert [tuple(r) for r in got] == [(["a"], 1, 12.5, 0, 10.0, None), (["a", "b"], 0, None, 1, 10.0, None)]
