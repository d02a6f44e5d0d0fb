"""DuckDB SQL that gives the same rows as the queries of this folder."""


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def secret_scan(rules, n_base):
    """Spans of each rule by running sums over its matches and what lies between."""
    found = " UNION ALL ".join(f"""
        SELECT row_id, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least,
               unnest(list_transform(range(1, len(m) + 1), lambda i: {{
                   'start': list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
                   'size': length(m[i]), 'kept': length(k[i])}})) AS s
        FROM (SELECT row_id, regexp_extract_all(t, {_quoted(rule.regex)}) AS m,
                     regexp_extract_all(t, {_quoted(rule.regex)}, {rule.group}) AS k,
                     string_split_regex(t, {_quoted(rule.regex)}) AS gaps FROM d)"""
                         for rank, rule in enumerate(rules))
    counts = ", ".join(f"count(*) FILTER (kind = '{rules[i].kind}') AS n_{rules[i].kind}" for i in range(n_base))
    names = ", ".join(f"n_{rules[i].kind}" for i in range(n_base))
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),
    spans AS (SELECT row_id, rank, kind, s.start AS start, s.start + s.size AS stop FROM ({found}) WHERE s.kept >= least),
    texts AS (SELECT row_id, rank, kind, start, kind || ':' || start::BIGINT || ':' || stop::BIGINT AS span FROM spans),
    found AS (SELECT row_id, {counts},
        coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {n_base}), '') AS base,
        string_agg(span, ',' ORDER BY start, rank) AS spans FROM texts GROUP BY row_id)
    SELECT doc_id, {", ".join(f"coalesce({n}, 0) AS {n}" for n in names.split(", "))},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN found USING (row_id)"""


_DECONTAMINATION = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
b AS (SELECT item_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM (SELECT DISTINCT item_id, text FROM benchmark)),
windows AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, w[s:s + least(13, len(w)) - 1] AS words
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM windows),
grams AS (SELECT row_id, m, p, w[p:p + m - 1] AS words
    FROM (SELECT row_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT row_id, item_id, p, m FROM grams JOIN windows USING (m, words)),
n_hit AS (SELECT row_id, count(DISTINCT q) AS n_hit FROM (SELECT row_id, unnest(range(p, p + m)) AS q FROM hits) GROUP BY row_id),
items AS (SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row_id),
items_in AS (SELECT row_number() OVER () AS item, item_id, w FROM b WHERE len(w) > 0),
asked AS (SELECT DISTINCT unnest(w) AS term FROM items_in),
postings AS (SELECT row_id, p, w[p] AS term FROM (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) WHERE w[p] IN (SELECT term FROM asked)),
counts AS (SELECT term, count(*) AS n FROM postings GROUP BY term),
places AS (SELECT item, s, p, w[p] AS term, least(13, len(w)) AS m
    FROM (SELECT item, w, s, unnest(range(s, s + least(13, len(w)))) AS p
        FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM items_in))),
anchors AS (SELECT item, s, p, term, least(:anchors, m) AS n_anchors FROM (
    SELECT item, s, p, term, m, row_number() OVER (PARTITION BY item, s ORDER BY n, p) AS rank, count(*) OVER (PARTITION BY item, s) AS known
    FROM places JOIN counts USING (term)) WHERE known = m AND rank <= :anchors),
shifts AS (SELECT row_id, item, s, n_anchors, anchors.p AS place, postings.p - anchors.p AS shift FROM postings JOIN anchors USING (term)),
near AS (SELECT DISTINCT row_id, item FROM (
    SELECT x.row_id, x.item, x.s, x.shift, x.n_anchors, count(DISTINCT y.place) AS seen
    FROM shifts x JOIN shifts y ON x.row_id = y.row_id AND x.item = y.item AND x.s = y.s AND y.shift BETWEEN x.shift AND x.shift + :slop
    GROUP BY ALL) WHERE seen = n_anchors),
near_items AS (SELECT row_id, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near_ids
    FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS item FROM near JOIN items_in USING (item) WHERE item_id IS NOT NULL) GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0) AS n_near, sha256(coalesce(near_ids, '')) AS near_sha256
FROM d LEFT JOIN n_hit USING (row_id) LEFT JOIN items USING (row_id) LEFT JOIN near_items USING (row_id)"""


def decontamination(anchors, slop):
    """Exact windows, and items whose anchors' shifts in a document differ by the slop at most."""
    return _DECONTAMINATION.replace(":anchors", str(anchors)).replace(":slop", str(slop))


JACCARD = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row_id, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents),
s AS (SELECT DISTINCT row_id, w[p:p + 2] AS shingle
    FROM (SELECT row_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT row_id, count(*) AS n FROM s GROUP BY row_id),
common AS (SELECT x.row_id AS a, y.row_id AS b, count(*) AS c FROM s x JOIN s y USING (shingle) WHERE x.row_id <> y.row_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n na ON na.row_id = a JOIN n nb ON nb.row_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
reach AS (SELECT row_id AS a, row_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (row_id) JOIN reach ON reach.a = d.row_id JOIN d o ON o.row_id = reach.b
GROUP BY d.row_id, d.doc_id, n.n"""


RANKING = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS w
    FROM (SELECT DISTINCT item_id, text FROM benchmark)),
total AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
sizes AS (SELECT row_id, doc_id, 10 + (90 * len(w) * n_docs) // n_terms AS m FROM d, total WHERE len(w) > 0),
asked AS (SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(w) AS term FROM b)),
scores AS (SELECT item, item_id, row_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (row_id) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""
