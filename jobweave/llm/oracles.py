"""SQL of those queries of the subpackage that SQL can express and that are quick enough on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(pattern: str) -> str:
    return f"regexp_extract_all({_LOWER}, '{pattern}')"


_ITEM_WORDS = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PLAIN_WORDS = _words(r"[^\x20\x09-\x0D]+")

ORACLES = {
    "op8_decontamination": f"""
        WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ITEM_WORDS} AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(10, len(w)) AS n
               FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
        m AS (SELECT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw USING (win)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op9_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
               FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        p AS MATERIALIZED (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * common >= 90 * (nx.n + ny.n - common)),
        reach AS (SELECT doc_id, doc_id AS label FROM documents UNION SELECT p.y, reach.label FROM reach JOIN p ON p.x = reach.doc_id)
        SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(label) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op11_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
        sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        runs AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
                 FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w CROSS JOIN (VALUES (1), (2), (3)) AS t(k) WHERE len(w) >= k)),
        f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 10),
        c AS (SELECT lang, k AS size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        cuts AS (SELECT lang, size, phrase, a, k, array_to_string(w[:k], ' ') AS lhs, array_to_string(w[k + 1:], ' ') AS rhs
                 FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
        scored AS (SELECT cuts.lang, size, cuts.phrase, cuts.a, cuts.k, x.a AS l, y.a AS r,
                          CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
                   FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lhs JOIN f y ON y.lang = cuts.lang AND y.phrase = rhs),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (SELECT lang, phrase, max(a) AS b FROM (SELECT lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS phrase, a FROM c WHERE size = 3) GROUP BY ALL),
        kept AS (SELECT weakest.* FROM weakest LEFT JOIN longer USING (lang, phrase) WHERE b IS NULL OR 100 * b < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000""",
}
