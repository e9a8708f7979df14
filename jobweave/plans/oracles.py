"""Plain SQL for DuckDB that gives the same result as each registered query."""

from __future__ import annotations

from jobweave.functions import fixed
from jobweave.plans.views import (
    PRIORITY_YEARS,
    RULE_SKILLS,
    TEST_GAZETTEER,
    TEST_SKILLS,
    TEST_STOP_WORDS,
)


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_q(v) for v in values)


_PUNCT_CLASS = "[" + "".join("\\" + c for c in fixed.REMOVED_PUNCTUATION) + "]"


def clean(column: str) -> str:
    stripped = f"regexp_replace(lower({column}), {_q(_PUNCT_CLASS)}, '', 'g')"
    return f"coalesce(trim(regexp_replace({stripped}, {_q(fixed.WHITESPACE_PATTERN)}, ' ', 'g')), '')"


def skills(column: str, terms=TEST_SKILLS) -> str:
    cases = [
        f"CASE WHEN regexp_matches({column}, {_q(f'(^|[^{fixed.WORD_CHARACTER}]){t}([^{fixed.WORD_CHARACTER}]|$)')}) THEN {_q(t)} END"
        for t in terms
    ]
    return f"list_sort(list_filter([{', '.join(cases)}], lambda s: s IS NOT NULL))"


def _years(column: str) -> str:
    cases = " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in PRIORITY_YEARS.items())
    return f"CAST(CASE {column} {cases} ELSE {fixed.EXPERIENCE_DEFAULT} END AS INTEGER)"


def hash_bits(column: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({column} AS VARCHAR)), 1, 15) AS BIGINT)"


_TOKENS = (
    f"list_filter(regexp_extract_all(lower(text), {_q(f'[{fixed.WORD_CHARACTER}]{{2,}}')}), "
    f"lambda w: w NOT IN ({_list(TEST_STOP_WORDS)}))"
)

_NGRAMS = (
    "list_concat(t, list_transform(range(1, greatest(len(t), 1)), lambda i: t[i] || ' ' || t[i + 1]))"
)

# The views of jobweave.plans.views.
VIEWS = {
    "resumes": (
        [],
        "SELECT d.doc_id AS resume_id, d.text, CAST(e.embedding AS DOUBLE[]) AS embedding FROM documents d "
        "LEFT JOIN embeddings e ON e.vec_id = d.doc_id WHERE d.doc_id IN (SELECT doc_id FROM labels)",
    ),
    "jobs": (
        [],
        "SELECT d.doc_id AS job_id, d.source AS title, d.lang AS category, d.text AS description, "
        "CAST(e.embedding AS DOUBLE[]) AS embedding FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id "
        "WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)",
    ),
    "r": (
        ["resumes"],
        f"SELECT resume_id, embedding, {skills('c')} AS skills FROM (SELECT *, {clean('text')} AS c FROM resumes)",
    ),
    "j": (
        ["jobs"],
        f"SELECT job_id, title, description, embedding, {skills('c')} AS skills "
        f"FROM (SELECT *, {clean('description')} AS c FROM jobs)",
    ),
    "event_items": (
        [],
        "SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, event_type FROM events",
    ),
    "interactions": (
        ["event_items"],
        "SELECT DISTINCT user_id, item_id FROM event_items WHERE event_type IN ('click', 'purchase') AND item_id IS NOT NULL",
    ),
    "applications": (
        ["event_items", "resumes", "jobs"],
        "SELECT user_id AS resume_id, item_id AS job_id FROM event_items WHERE event_type IN ('click', 'purchase') "
        "AND user_id IN (SELECT resume_id FROM resumes) AND item_id IN (SELECT job_id FROM jobs) GROUP BY ALL",
    ),
    "pair_scores": (
        ["r", "j", "applications"],
        "SELECT resume_id, job_id, {kw} AS keyword, {cos} AS cosine FROM applications JOIN r USING (resume_id) JOIN j USING (job_id)",
    ),
    "all_scores": (
        ["r", "j"],
        "SELECT resume_id, job_id, {kw} AS keyword, {cos} AS cosine, title, description, j.skills AS skills FROM r CROSS JOIN j",
    ),
    "postings": (
        [],
        "SELECT o_orderkey AS job_id, c_mktsegment AS title, n_name AS location, o_orderpriority AS experience_level, "
        "o_totalprice * CAST(0.9 AS DOUBLE) AS salary_min, o_totalprice * CAST(1.1 AS DOUBLE) AS salary_max, "
        "o_orderdate AS date_posted, o_orderstatus AS status, n_regionkey AS region "
        "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    ),
    "salary_features": (
        ["postings"],
        f"SELECT job_id, title, location, {_years('experience_level')} AS experience_numeric, "
        "CASE WHEN salary_min <> 0 AND salary_max <> 0 THEN (salary_min + salary_max) / 2 END AS salary_midpoint FROM postings",
    ),
    "title_means": (
        ["salary_features"],
        "SELECT *, avg(salary_midpoint) OVER (PARTITION BY title) AS predicted FROM salary_features",
    ),
    "posting_skill_rows": (
        [],
        "SELECT o_orderkey AS job_id, o_orderdate AS date_posted, unnest(string_split(p_name, ' ')) AS skill "
        "FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey",
    ),
    "skill_trends": (
        ["posting_skill_rows"],
        "SELECT strftime(date_posted, '%Y-%m') AS period, lower(skill) AS skill, count(*) AS count FROM posting_skill_rows GROUP BY ALL",
    ),
    "part_requests": (
        [],
        "SELECT p_partkey AS request_id, list_transform(string_split(p_name, ' '), lambda w: CASE "
        + " ".join(f"WHEN w = {_q(k)} THEN {_q(v)}" for k, v in RULE_SKILLS.items())
        + " ELSE w END) AS skills, p_size AS years, CASE p_type WHEN 'ECONOMY' THEN 'San Francisco, CA' WHEN 'PROMO' THEN NULL "
        "ELSE 'Remote' END AS location, CASE WHEN p_type <> 'PROMO' THEN [lower(p_type), lower(p_brand)] END AS listed FROM part",
    ),
    "offers": (
        ["title_means", "postings"],
        "SELECT p.job_id AS offer_id, (p.job_id % 100) / CAST(100 AS DOUBLE) AS match_score, "
        "(t.salary_midpoint - t.predicted) / t.predicted * 100 AS salary_diff_percentage FROM postings p JOIN title_means t USING (job_id)",
    ),
    "guesses": (
        [],
        "SELECT doc_id, lang AS actual, CASE WHEN contains(c, ' the ') THEN 'en' WHEN contains(c, ' le ') OR contains(c, ' la ') THEN 'fr' "
        "WHEN contains(c, ' der ') OR contains(c, ' die ') THEN 'de' ELSE 'es' END AS predicted "
        f"FROM (SELECT doc_id, lang, ' ' || {clean('text')} || ' ' AS c FROM documents)",
    ),
    "class_scores": (
        ["guesses"],
        "SELECT *, CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END AS f1 FROM (SELECT *, "
        "CASE WHEN chosen = 0 THEN 0 ELSE tp / chosen END AS prec, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS rec FROM ("
        "SELECT label, (SELECT CAST(count(*) AS DOUBLE) FROM guesses WHERE actual = label AND predicted = label) AS tp, "
        "(SELECT CAST(count(*) AS DOUBLE) FROM guesses WHERE actual = label) AS support, "
        "(SELECT CAST(count(*) AS DOUBLE) FROM guesses WHERE predicted = label) AS chosen "
        "FROM (SELECT actual AS label FROM guesses UNION SELECT predicted FROM guesses)))",
    ),
    "ngrams": (
        [],
        f"SELECT doc_id, lang, unnest({_NGRAMS}) AS term FROM (SELECT doc_id, lang, {_TOKENS} AS t FROM documents)",
    ),
    "unigrams": ([], f"SELECT doc_id, lang, unnest({_TOKENS}) AS term FROM documents"),
}

_KEYWORD = (
    "CASE WHEN len(r.skills) = 0 OR len(j.skills) = 0 THEN CAST(0 AS DOUBLE) ELSE "
    "CAST(len(list_intersect(r.skills, j.skills)) AS DOUBLE) / len(list_distinct(list_concat(r.skills, j.skills))) END"
)
_COSINE = "coalesce(list_cosine_similarity(r.embedding, j.embedding), CAST(0 AS DOUBLE))"


def _needs(name: str, seen: list[str]) -> None:
    for other in VIEWS[name][0]:
        _needs(other, seen)
    if name not in seen:
        seen.append(name)


def sql(body: str, *uses: str) -> str:
    """``body`` preceded by the views it uses."""
    order: list[str] = []
    for name in uses:
        _needs(name, order)
    # A view is computed once however often it is read.
    parts = [
        f"{n} AS MATERIALIZED ({VIEWS[n][1].replace('{kw}', _KEYWORD).replace('{cos}', _COSINE)})" for n in order
    ]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _array(column: str, name: str) -> str:
    return f"coalesce(array_to_string({column}, '|'), '') AS {name}"


_SCORE = "0.2::DOUBLE * keyword + 0.5::DOUBLE * cosine + 0.3::DOUBLE * cosine"
_SCORES = f"round(keyword, 6) AS keyword, round(cosine, 6) AS cosine, round(cosine, 6) AS learned, round({_SCORE}, 6) AS score"

_GAZETTEER = " UNION ".join(
    [
        *(f"SELECT {_q(label)} AS label, {_q(phrase)} AS phrase" for label, phrase in TEST_GAZETTEER),
        "SELECT 'GPE', lower(n_name) FROM nation",
        "SELECT 'LOC', lower(r_name) FROM region",
    ]
)

_SEGMENTS = f"[{fixed.WORD_CHARACTER}]+|[^{fixed.WORD_CHARACTER}]+"


def _phrase_hits(source: str, text: str, phrases: str) -> str:
    """Rows doc_id, pos, phrase: neighbouring segments of a text that spell a phrase of up to three words."""
    grams = "unnest([s, s || lead(s, 1) OVER w || lead(s, 2) OVER w, s || lead(s, 1) OVER w || lead(s, 2) OVER w || lead(s, 3) OVER w || lead(s, 4) OVER w])"
    return (
        f"SELECT doc_id, i AS pos, p.phrase FROM (SELECT doc_id, i, {grams} AS gram FROM "
        f"(SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS s FROM "
        f"(SELECT doc_id, regexp_extract_all({text}, {_q(_SEGMENTS)}) AS l FROM {source})) "
        "WINDOW w AS (PARTITION BY doc_id ORDER BY i)) x "
        f"JOIN {phrases} p ON x.gram = p.phrase"
    )


def _tfidf(grams: str, fit: str, min_df: int, max_df: float, top: int | None = None) -> str:
    limit = f"ORDER BY cf DESC, term LIMIT {top}" if top else ""
    return (
        f"tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM {grams} GROUP BY ALL), "
        f"fit AS (SELECT doc_id FROM documents WHERE {fit}), "
        f"n AS (SELECT count(*) AS n FROM fit), "
        f"v AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf WHERE doc_id IN (SELECT doc_id FROM fit) GROUP BY term "
        f"HAVING count(*) >= {min_df} AND count(*) <= (SELECT n FROM n) * CAST({max_df} AS DOUBLE) {limit}), "
        "w AS (SELECT doc_id, term, tf, df, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM tf JOIN v USING (term) CROSS JOIN n) "
        "SELECT doc_id, term, tf, df, round(idf, 6) AS idf, "
        "round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w"
    )


def _build() -> dict[str, str]:
    bits = hash_bits
    out: dict[str, str] = {}
    # sources and service views
    out["write_job_postings"] = sql(
        f"SELECT CAST(job_id AS VARCHAR) AS job_id, title, location, {_r6('salary_min', 'salary_max')}, experience_level FROM postings",
        "postings",
    )
    out["upload_preview"] = (
        f"SELECT doc_id, coalesce(substr(text, 1, {fixed.UPLOAD_PREVIEW_CHARS}), '(no preview)') AS preview FROM documents"
    )
    out["list_jobs"] = sql(f"SELECT job_id, title, description, {_array('skills', 'skills')} FROM j", "j")
    # text
    out["clean_text"] = f"SELECT doc_id, {clean('text')} AS cleaned_text FROM documents"
    preview = (
        f"coalesce(CASE WHEN length(text) > {fixed.PREVIEW_CHARS} THEN substr(text, 1, {fixed.PREVIEW_CHARS}) || '...' ELSE text END, '')"
    )
    out["text_preview"] = f"SELECT doc_id, {preview} AS preview FROM documents"
    out["extract_skills"] = (
        f"SELECT doc_id, {_array(skills('c'), 'skills')} FROM (SELECT doc_id, {clean('text')} AS c FROM documents)"
    )
    out["match_vocabulary"] = (
        "WITH vocabulary AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS phrase FROM part UNION SELECT unnest(["
        + _list(TEST_SKILLS)
        + f"])), hits AS ({_phrase_hits('documents', 'lower(text)', 'vocabulary')}) "
        "SELECT DISTINCT doc_id, phrase AS skill FROM hits"
    )
    emails = f"regexp_extract_all(text, {_q(fixed.EMAIL_PATTERN)})"
    phones = f"regexp_extract_all(text, {_q(fixed.PHONE_PATTERN)})"
    out["extract_emails"] = f"SELECT doc_id, {_array(emails, 'emails')} FROM documents"
    out["extract_phones"] = f"SELECT doc_id, {_array(phones, 'phones')} FROM documents"
    out["tag_entities"] = (
        f"WITH c AS MATERIALIZED (SELECT doc_id, {clean('text')} AS c FROM documents), gazetteer AS ({_GAZETTEER}), "
        f"phrases AS (SELECT DISTINCT phrase FROM gazetteer), hits AS ({_phrase_hits('c', 'c', 'phrases')}), "
        "found AS (SELECT doc_id, label, string_agg(phrase, '|' ORDER BY pos, phrase) AS mentions FROM hits JOIN gazetteer USING (phrase) GROUP BY ALL), "
        f"labels7 AS (SELECT unnest([{_list(fixed.ENTITY_LABELS)}]) AS label) "
        "SELECT doc_id, label, coalesce(mentions, '') AS mentions FROM (SELECT doc_id, label FROM documents CROSS JOIN labels7) "
        "LEFT JOIN found USING (doc_id, label)"
    )
    out["merge_skills"] = sql(
        f"SELECT request_id, {_array('list_concat(coalesce(skills, []), coalesce(listed, []))', 'merged')} FROM part_requests",
        "part_requests",
    )
    out["preprocess_documents"] = (
        f"SELECT doc_id, {preview} AS original_text_preview, c AS cleaned_text, {_array(skills('c'), 'skills')}, "
        f"{_array(emails, 'emails')}, {_array(phones, 'phone_numbers')} "
        f"FROM (SELECT doc_id, text, {clean('text')} AS c FROM documents)"
    )
    entities = " || ';' || ".join(f"'{name}=' || max(mentions) FILTER (label = '{name}')" for name in fixed.ENTITY_LABELS)
    out["preprocess_with_entities"] = (
        f"SELECT * FROM ({out['preprocess_documents']}) JOIN (SELECT doc_id, {entities} AS entities FROM ({out['tag_entities']}) GROUP BY doc_id) USING (doc_id)"
    )
    components = (
        f"t AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents), "
        f"c AS (SELECT doc_id, CAST({hash_bits('term')} % {fixed.EMBEDDING_DIM} AS INTEGER) AS slot, count(*) AS tf FROM t GROUP BY ALL), "
        "w AS (SELECT slot, ln(CAST((SELECT count(*) FROM documents) + 1 AS DOUBLE) / (count(*) + 1)) AS idf FROM c GROUP BY slot), "
        "weighed AS (SELECT doc_id, slot, tf * idf AS raw FROM c JOIN w USING (slot)), "
        "components AS MATERIALIZED (SELECT * FROM (SELECT doc_id, slot, raw / nullif(sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 0) AS value FROM weighed) WHERE value <> 0)"
    )
    out["hashed_components"] = f"WITH {components} SELECT doc_id, slot, round(value, 6) AS value FROM components"
    out["tokenize_ngrams"] = (
        f"SELECT doc_id, {_array(_NGRAMS, 'tokens')} FROM (SELECT doc_id, {_TOKENS} AS t FROM documents)"
    )
    # posting and offer columns
    out["experience_numeric"] = sql("SELECT job_id, experience_numeric FROM salary_features", "salary_features")
    out["skill_count"] = sql("SELECT request_id, CAST(coalesce(len(listed), 0) AS INTEGER) AS skill_count FROM part_requests", "part_requests")
    out["salary_midpoint"] = sql(
        "SELECT job_id, round(salary_midpoint, 4) AS salary_midpoint FROM salary_features WHERE salary_midpoint IS NOT NULL",
        "salary_features",
    )
    out["salary_diff_pct"] = sql("SELECT offer_id, round(salary_diff_percentage, 6) AS salary_diff_percentage FROM offers", "offers")
    out["rule_salary_range"] = sql(
        "SELECT request_id, round(a * 0.9::DOUBLE, 4) AS salary_min, round(a * 1.1::DOUBLE, 4) AS salary_max, 'USD' AS currency FROM ("
        "SELECT request_id, (40000::DOUBLE + 10000 * years + 2000 * len(skills) "
        "+ CASE WHEN list_has_any(skills, ['aws', 'cloud']) THEN 5000 ELSE 0 END "
        "+ CASE WHEN list_contains(skills, 'python') THEN 3000 ELSE 0 END) "
        "* CASE WHEN contains(location, 'Francisco') THEN 1.2::DOUBLE ELSE 1 END AS a FROM part_requests)",
        "part_requests",
    )
    out["coerce_numeric"] = (
        "SELECT p_partkey, raw, TRY_CAST(raw AS DOUBLE) AS number FROM (SELECT p_partkey, "
        "unnest([replace(p_brand, 'Brand#', ''), p_type]) AS raw FROM part) WHERE TRY_CAST(raw AS DOUBLE) IS NOT NULL"
    )
    out["drop_nulls"] = sql("SELECT job_id, title FROM jobs WHERE title IS NOT NULL AND embedding IS NOT NULL", "jobs")
    out["threshold_label"] = sql("SELECT offer_id, CAST(match_score > 0.5::DOUBLE AS INTEGER) AS label FROM offers", "offers")
    # features
    is_train = f"{bits('doc_id')} % 100 < 80"
    out["tfidf_terms"] = sql("", "ngrams").strip() + ", " + _tfidf("ngrams", is_train, 2, 0.95)
    out["tfidf_top_features"] = sql("", "unigrams").strip() + ", " + _tfidf("unigrams", "true", 5, 0.7, 1000)
    out["standard_scale"] = sql(
        "SELECT job_id, " + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_scaled" for c in ("experience_numeric", "salary_midpoint")
        ) + " FROM salary_features",
        "salary_features",
    )
    out["standard_scale_vector"] = (
        "SELECT vec_id, CAST(d - 1 AS INTEGER) AS dim, round((x - avg(x) OVER (PARTITION BY d)) / stddev_pop(x) OVER (PARTITION BY d), 5) AS value "
        "FROM (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"
    )
    out["one_hot"] = sql(
        f"SELECT job_id, CAST(slot AS INTEGER) AS slot, location AS level FROM salary_features JOIN (SELECT location, row_number() OVER (ORDER BY location) - 1 AS slot "
        f"FROM (SELECT DISTINCT location FROM salary_features WHERE {bits('job_id')} % 100 < 80)) USING (location)",
        "salary_features",
    )
    # matching
    out["keyword_overlap"] = sql(f"SELECT resume_id, job_id, {_r6('keyword')} FROM pair_scores", "pair_scores")
    out["keyword_pairs"] = sql(f"SELECT resume_id, job_id, {_r6('keyword')} FROM all_scores WHERE keyword >= CAST(0.25 AS DOUBLE)", "all_scores")
    out["keyword_top5"] = sql(
        f"SELECT resume_id, job_id, {_r6('keyword')}, CAST(row_number() OVER (PARTITION BY resume_id ORDER BY all_scores.keyword DESC, job_id) AS INTEGER) AS rank "
        "FROM all_scores WHERE all_scores.keyword >= CAST(0.1 AS DOUBLE) QUALIFY rank <= 5",
        "all_scores",
    )
    out["cosine_pairs"] = sql(f"SELECT resume_id, job_id, {_r6('cosine')} FROM pair_scores", "pair_scores")
    out["combined_score"] = sql(f"SELECT resume_id, job_id, {_SCORES} FROM pair_scores", "pair_scores")
    out["match_one_resume"] = sql(
        f"SELECT resume_id, job_id, {_SCORES} FROM all_scores WHERE resume_id = (SELECT min(resume_id) FROM resumes)", "all_scores"
    )
    ranked = (
        "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY resume_id ORDER BY round({score}, 6) DESC, job_id) AS INTEGER) AS rank "
        "FROM all_scores) WHERE rank <= {k}"
    )
    best = lambda score, k: ranked.replace("{score}", score).replace("{k}", str(k))
    out["match_all_topk"] = sql(f"SELECT resume_id, job_id, {_SCORES}, rank FROM ({best(_SCORE, 5)})", "all_scores")
    out["all_scores_histogram"] = sql("", "all_scores").strip() + (
        f""", s AS (SELECT {_SCORE} AS x FROM all_scores), e AS (SELECT min(x) AS lo, (max(x) - min(x)) / 20 AS w FROM s),
        h AS (SELECT CAST(least(floor((x - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM s CROSS JOIN e GROUP BY ALL),
        g AS (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin)
        SELECT bin, round(lo + bin * w, 6) AS low, round(lo + (bin + 1) * w, 6) AS high, coalesce(n, 0) AS n FROM g CROSS JOIN e LEFT JOIN h USING (bin)"""
    )
    # splits
    out["hash_split"] = sql(f"SELECT job_id, {bits('job_id')} % 100 < 80 AS is_train FROM postings", "postings")
    out["stratified_split"] = (
        f"SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {bits('doc_id')}, doc_id) "
        "<= floor(count(*) OVER (PARTITION BY lang) * 0.8::DOUBLE + 0.5) AS is_train FROM documents"
    )
    out["half_split"] = (
        "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) <= floor(count(*) OVER () / 2) AS is_first_half FROM orders"
    )
    out["half_split_by_name"] = (
        "SELECT job_id, row_number() OVER (ORDER BY job_id) <= floor(count(*) OVER () / 2) AS is_first_half "
        "FROM (SELECT 'job' || CAST(o_orderkey AS VARCHAR) AS job_id FROM orders)"
    )
    out["balanced_weights"] = (
        "SELECT lang, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight "
        "FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)"
    )
    out["assign_clusters"] = (
        "WITH dims AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), "
        "c AS (SELECT label AS cluster, list(m ORDER BY d) AS center FROM (SELECT label, d, avg(x) AS m FROM dims GROUP BY ALL) GROUP BY label), "
        "dist AS (SELECT vec_id, cluster, round(list_distance(CAST(embedding AS DOUBLE[]), center), 6) AS distance FROM embeddings CROSS JOIN c) "
        "SELECT vec_id, cluster, distance FROM dist QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1"
    )
    # recommendation
    def content(k: int) -> str:
        return (
            "content AS MATERIALIZED (SELECT * FROM (SELECT resume_id, job_id, score, CAST(row_number() OVER (PARTITION BY resume_id ORDER BY round(score, 6) DESC, job_id) "
            f"AS INTEGER) AS rank FROM (SELECT resume_id, job_id, {_SCORE} AS score FROM all_scores WHERE resume_id IN "
            f"(SELECT resume_id FROM resumes WHERE {clean('text')} <> ''))) WHERE rank <= {k})"
        )

    out["recommend_content"] = sql("", "all_scores").strip() + f", {content(3)} SELECT resume_id, job_id, round(score, 6) AS score, rank FROM content"
    out["recommend_content_from_text"] = (
        sql("", "r", "j").strip()
        + f", {components}, cosines AS MATERIALIZED (SELECT a.doc_id AS resume_id, b.doc_id AS job_id, sum(a.value * b.value) AS c FROM components a JOIN components b USING (slot) "
        "WHERE a.doc_id IN (SELECT resume_id FROM r) AND b.doc_id IN (SELECT job_id FROM j) GROUP BY ALL), "
        f"every AS (SELECT resume_id, job_id, {_KEYWORD} AS keyword, coalesce(c, 0) AS cosine FROM r CROSS JOIN j LEFT JOIN cosines USING (resume_id, job_id)) "
        "SELECT resume_id, job_id, round(score, 6) AS score, rank FROM (SELECT resume_id, job_id, score, CAST(row_number() OVER (PARTITION BY resume_id ORDER BY round(score, 6) DESC, job_id) "
        f"AS INTEGER) AS rank FROM (SELECT resume_id, job_id, {_SCORE} AS score FROM every WHERE resume_id IN "
        f"(SELECT resume_id FROM resumes WHERE {clean('text')} <> ''))) WHERE rank <= 3"
    )
    out["recommend_cosine_top5"] = sql(
        f"SELECT resume_id, job_id, round(cosine, 6) AS match_score, rank, title, description, {_array('skills', 'skills')} FROM ({best('cosine', 5)})",
        "all_scores",
    )

    def peers(k: int) -> str:
        return (
            "sizes AS (SELECT user_id, count(*) AS n FROM interactions GROUP BY user_id), "
            "sim AS (SELECT a.user_id AS target, b.user_id AS peer, count(*) / sqrt(CAST(any_value(s1.n) AS DOUBLE) * any_value(s2.n)) AS w "
            "FROM interactions a JOIN interactions b ON a.item_id = b.item_id AND a.user_id <> b.user_id JOIN sizes s1 ON s1.user_id = a.user_id "
            "JOIN sizes s2 ON s2.user_id = b.user_id GROUP BY ALL), "
            "raw AS (SELECT target AS user_id, item_id, sum(w) AS score FROM sim JOIN interactions i ON i.user_id = sim.peer GROUP BY ALL), "
            "peers AS MATERIALIZED (SELECT * FROM (SELECT user_id, item_id, score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS INTEGER) AS rank "
            f"FROM raw ANTI JOIN interactions USING (user_id, item_id)) WHERE rank <= {k})"
        )

    out["recommend_collaborative"] = (
        sql("", "interactions").strip() + f", {peers(5)} SELECT user_id, item_id, round(score, 6) AS score, rank FROM peers"
    )
    out["recommend_hybrid"] = (
        sql("", "all_scores", "interactions").strip()
        + f", {content(10)}, {peers(10)}, "
        "merged AS (SELECT resume_id AS user_id, job_id AS item_id, 0 AS source, rank FROM content UNION ALL SELECT user_id, item_id, 1, rank FROM peers), "
        "first AS (SELECT user_id, item_id, min(source * 1000 + rank) AS place FROM merged GROUP BY ALL) "
        "SELECT user_id, item_id, CASE WHEN place < 1000 THEN 'content' ELSE 'collaborative' END AS source, rank FROM "
        "(SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY place, item_id) AS INTEGER) AS rank FROM first) WHERE rank <= 5"
    )
    out["recommend_cold_start"] = sql(
        "SELECT user_id, item_id, users, rank FROM (SELECT DISTINCT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM interactions)) "
        "CROSS JOIN (SELECT item_id, users, CAST(row_number() OVER (ORDER BY users DESC, item_id) AS INTEGER) AS rank FROM "
        "(SELECT item_id, count(*) AS users FROM interactions GROUP BY item_id)) WHERE rank <= 5",
        "interactions",
    )
    # trends
    out["skill_trends"] = sql("SELECT * FROM skill_trends", "skill_trends")
    out["first_period_top_skills"] = sql(
        "SELECT * FROM skill_trends WHERE period = (SELECT min(period) FROM skill_trends) ORDER BY count DESC, skill LIMIT 5", "skill_trends"
    )
    out["demand_trends"] = (
        "WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS postings FROM orders GROUP BY ALL), "
        "a AS (SELECT unnest(generate_series(min(CAST(month AS TIMESTAMP)), max(CAST(month AS TIMESTAMP)), INTERVAL 1 MONTH)) AS month FROM m) "
        "SELECT strftime(a.month, '%Y-%m') AS period, coalesce(postings, 0) AS postings FROM a LEFT JOIN m ON CAST(m.month AS TIMESTAMP) = a.month"
    )
    out["skill_frequency"] = sql(
        "SELECT skill, count(*) AS count FROM posting_skill_rows GROUP BY skill ORDER BY count DESC, skill LIMIT 10", "posting_skill_rows"
    )
    out["cluster_top_terms"] = sql("", "ngrams").strip() + (
        ", tf AS MATERIALIZED (SELECT lang AS cluster, doc_id, term, count(*) AS tf FROM ngrams GROUP BY ALL), "
        "docs AS (SELECT lang AS cluster, count(*) AS docs FROM documents GROUP BY lang), "
        "v AS (SELECT cluster, term, df FROM (SELECT cluster, term, count(*) AS df, row_number() OVER (PARTITION BY cluster ORDER BY sum(tf) DESC, term) AS r "
        "FROM tf GROUP BY cluster, term) WHERE r <= 1000), "
        "w AS (SELECT cluster, doc_id, term, tf * (ln((docs + 1)::DOUBLE / (df + 1)) + 1) AS raw FROM tf JOIN v USING (cluster, term) JOIN docs USING (cluster)), "
        "u AS (SELECT cluster, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS x FROM w), "
        "s AS (SELECT cluster, term, round(sum(x), 6) AS weight FROM u GROUP BY ALL) "
        "SELECT cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS INTEGER) AS rank, term, weight FROM s "
        "QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) <= 10"
    )
    out["avg_salary_by_title"] = sql(
        "SELECT title, count(*) AS postings, round(avg(salary_midpoint), 4) AS avg_salary FROM salary_features WHERE salary_midpoint IS NOT NULL GROUP BY title",
        "salary_features",
    )
    out["salary_distribution"] = sql(
        "SELECT title, n, round(q1, 4) AS q1, round(q2, 4) AS median, round(q3, 4) AS q3, "
        "round(min(salary_midpoint) FILTER (inside), 4) AS whisker_low, round(max(salary_midpoint) FILTER (inside), 4) AS whisker_high, "
        "count(*) FILTER (NOT inside) AS outliers FROM (SELECT *, salary_midpoint BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside "
        "FROM salary_features JOIN (SELECT title, count(*) AS n, quantile_cont(salary_midpoint, 0.25) AS q1, quantile_cont(salary_midpoint, 0.5) AS q2, "
        "quantile_cont(salary_midpoint, 0.75) AS q3 FROM salary_features GROUP BY title) USING (title)) GROUP BY title, n, q1, q2, q3",
        "salary_features",
    )
    out["match_score_histogram"] = (
        "WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events), "
        "h AS (SELECT CAST(least(floor((value - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM events CROSS JOIN e GROUP BY ALL), "
        "g AS (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin) "
        "SELECT bin, round(lo + bin * w, 6) AS low, round(lo + (bin + 1) * w, 6) AS high, coalesce(n, 0) AS n FROM g CROSS JOIN e LEFT JOIN h USING (bin)"
    )
    out["match_score_density"] = (
        "WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 199 AS step, count(value) AS n, "
        "stddev_samp(value) * pow(count(value), -0.2::DOUBLE) AS h FROM events), g AS (SELECT CAST(unnest(range(200)) AS INTEGER) AS point) "
        "SELECT point, round(any_value(lo + point * step), 6) AS x, "
        "round(sum(exp(-0.5::DOUBLE * pow((lo + point * step - value) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 9) AS density "
        "FROM g CROSS JOIN s CROSS JOIN events GROUP BY point"
    )
    out["class_distribution"] = "SELECT lang AS label, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang"
    out["cluster_sizes"] = "SELECT label AS cluster, count(*) AS members FROM embeddings GROUP BY label"
    # evaluation
    names = {"precision": "prec", "recall": "rec", "f1_score": "f1"}
    accuracy = "sum(tp) / sum(support)"
    rows = {
        "binary": {k: f"max({v}) FILTER (label = 'en')" for k, v in names.items()},
        "micro": {k: accuracy for k in names},
        "macro": {k: f"avg({v})" for k, v in names.items()},
        "weighted": {k: f"sum({v} * support) / sum(support)" for k, v in names.items()},
    }
    out["classification_metrics"] = sql(
        " UNION ALL ".join(
            f"SELECT '{a}' AS average, round({accuracy}, 6) AS accuracy, "
            + ", ".join(f"round({v}, 6) AS {k}" for k, v in values.items())
            + " FROM class_scores"
            for a, values in rows.items()
        ),
        "class_scores",
    )
    report = {"accuracy": "micro", "macro avg": "macro", "weighted avg": "weighted"}
    out["classification_report"] = sql(
        "SELECT label, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM class_scores UNION ALL "
        + " UNION ALL ".join(
            f"SELECT '{label}', " + ", ".join(f"round({v}, 6)" for v in rows[kind].values()) + ", CAST(sum(support) AS BIGINT) FROM class_scores"
            for label, kind in report.items()
        ),
        "class_scores",
    )
    out["confusion_matrix"] = sql(
        "SELECT a.label AS actual, b.label AS predicted, (SELECT count(*) FROM guesses g WHERE g.actual = a.label AND g.predicted = b.label) AS n "
        "FROM class_scores a CROSS JOIN class_scores b",
        "class_scores",
    )
    out["roc_auc"] = (
        "WITH s AS (SELECT CAST(event_type = 'purchase' AS INTEGER) AS label, value AS score FROM events), "
        "g AS (SELECT score, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS pos, CAST(count(*) FILTER (label = 0) AS DOUBLE) AS neg FROM s GROUP BY score), "
        "c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) "
        "SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, "
        "round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM c"
    )
    out["regression_metrics"] = sql(
        "SELECT round(avg(pow(salary_midpoint - predicted, 2)), 2) AS mse, round(sqrt(avg(pow(salary_midpoint - predicted, 2))), 4) AS rmse FROM title_means",
        "title_means",
    )
    out["r2_mae"] = sql(
        "SELECT round(1 - sum(pow(salary_midpoint - predicted, 2)) / (var_pop(salary_midpoint) * count(*)), 6) AS r2, "
        "round(avg(abs(salary_midpoint - predicted)), 4) AS mae FROM title_means",
        "title_means",
    )
    out["ranking_metrics_at_k"] = sql(
        "SELECT CAST(k AS INTEGER) AS k, count(*) AS users, round(avg(CAST(hits AS DOUBLE) / k), 6) AS avg_precision, "
        "round(avg(CASE WHEN n_actual = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / n_actual END), 6) AS avg_recall FROM (SELECT k, u.user_id, "
        "(SELECT count(DISTINCT item_id) FROM event_items p WHERE p.event_type = 'purchase' AND p.user_id = u.user_id) AS n_actual, "
        "(SELECT count(*) FROM recs r WHERE r.user_id = u.user_id AND r.rank <= k AND EXISTS "
        "(SELECT 1 FROM event_items p WHERE p.event_type = 'purchase' AND p.user_id = r.user_id AND p.item_id = r.item_id)) AS hits "
        "FROM (SELECT DISTINCT user_id FROM recs) u CROSS JOIN (SELECT unnest([5, 10]) AS k)) GROUP BY k",
        "event_items",
    ).replace(
        " SELECT CAST(k", ", recs AS MATERIALIZED (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, item_id) AS rank "
        "FROM event_items WHERE event_type = 'click' GROUP BY user_id, item_id) WHERE rank <= 10) SELECT CAST(k", 1
    )
    out["actual_vs_predicted"] = sql(
        "SELECT job_id, round(salary_midpoint, 4) AS salary_midpoint, round(predicted, 4) AS predicted FROM title_means", "title_means"
    )
    return out


ORACLES = _build()
