"""DuckDB SQL of the queries that SQL can state: op1, op4, op7, op8 and op12."""

from __future__ import annotations

from punctual.llm.licenses import LEAST, LOWER, PHRASES, TEMPLATES, UPPER


def _words(text: str, pattern: str) -> str:
    low = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return f"list_filter(regexp_split_to_array({low}, '{pattern}'), lambda x: x <> '')"


_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _components(nodes: str, links: str) -> str:
    """CTEs: component(id, component_id), the smallest id that links reach."""
    return f"""both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
reach(id, other) AS (SELECT id, id FROM {nodes} UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


OP1 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.label = b.label AND a.id < b.id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_components("nodes", "pairs")},
counts AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT c.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, c.id = component_id AS kept
FROM component c LEFT JOIN counts USING (id)"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id AS id, {_words("text", "[\\x20\\x09-\\x0D]+")} AS w FROM documents),
s AS (SELECT id, unnest(CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS t FROM d),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
common AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.id < b.id GROUP BY 1, 2),
pairs AS (SELECT a, b FROM common JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
{_components("d", "pairs")}
SELECT c.id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM component c LEFT JOIN n USING (id)"""

OP7 = f"""
WITH b AS (SELECT item_id, {_words("text", _ALNUM)} AS w FROM benchmark),
item_windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
  unnest(CASE WHEN len(w) > 0 THEN list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' ')) ELSE [] END) AS t FROM b),
d AS (SELECT doc_id, {_words("text", _ALNUM)} AS w FROM documents),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM item_windows)),
doc_windows AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS t FROM starts),
hits AS (SELECT doc_id, d.n, p, item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.t = i.t),
places AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS k FROM hits) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows) + ")"


def _licences() -> str:
    words, heads = [], []
    for k, (label, text, key) in enumerate(TEMPLATES):
        template, phrase = text.split(" "), key.split(" ")
        at = next(i for i in range(len(template)) if template[i : i + len(phrase)] == phrase)
        heads.append((k, label, at, len(phrase)))
        words += [(k, i, w) for i, w in enumerate(template)]
    phrases = [(label, i, w, len(p.split(" "))) for p, label in PHRASES.items() for i, w in enumerate(p.split(" "))]
    return f"""
WITH d AS (SELECT doc_id, {_words("text", _ALNUM)} AS w FROM documents),
word AS (SELECT doc_id, unnest(range(0, len(w))) AS pos, unnest(w) AS w FROM d),
template(t, i, w) AS {_values(words)},
head(t, label, key_at, key_n) AS {_values(heads)},
phrase(label, i, w, n) AS {_values(phrases)},
base AS (SELECT doc_id, label, pos - i AS start FROM word JOIN phrase USING (w) GROUP BY doc_id, label, start HAVING count(*) = max(n)),
base_of AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM base GROUP BY doc_id),
vocabulary AS (SELECT DISTINCT w FROM template),
frequency AS (SELECT w, count(DISTINCT doc_id) AS df FROM word JOIN vocabulary USING (w) GROUP BY w),
weight AS (SELECT w, round(ln(((SELECT count(*) FROM documents) + 1) / (coalesce(df, 0) + 1)), 9) AS x FROM vocabulary LEFT JOIN frequency USING (w)),
rare AS (SELECT t, w, i FROM (SELECT t, w, min(i) AS i, any_value(x) AS x FROM template JOIN weight USING (w) GROUP BY t, w)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY x DESC, w) <= 2),
starts AS (SELECT doc_id, t, pos - i AS start FROM word JOIN rare USING (w) GROUP BY ALL HAVING count(*) = 2),
placed AS (SELECT s.doc_id, s.t, s.start, sum(x) FILTER (word.w = m.w) / sum(x) AS share,
    count(*) FILTER (word.w = m.w AND i >= key_at AND i < key_at + key_n) AS keys, any_value(key_n) AS key_n, any_value(label) AS label
  FROM starts s JOIN head USING (t) JOIN template m USING (t) JOIN weight ON weight.w = m.w
  LEFT JOIN word ON word.doc_id = s.doc_id AND word.pos = s.start + m.i GROUP BY s.doc_id, s.t, s.start),
matched AS (SELECT doc_id, label, share FROM placed WHERE keys = key_n AND share >= {LEAST}),
labelled AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM matched) GROUP BY doc_id),
base_labels AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
top AS (SELECT doc_id, max(share) AS share FROM matched GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(greatest(coalesce(share, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END), 6)::DOUBLE AS score
FROM d LEFT JOIN base_of USING (doc_id) LEFT JOIN labelled USING (doc_id) LEFT JOIN base_labels USING (doc_id) LEFT JOIN top USING (doc_id)"""


OP12 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5"""

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": OP1,
    "op4_jaccard_join": OP4,
    "op7_decontaminate": OP7,
    "op8_licenses": _licences(),
    "op12_topk": OP12,
}
