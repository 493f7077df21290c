"""DuckDB SQL with the same rows as the queries, where SQL can express them.

Token ids (op1, op10, op11), the learned models (op7, op8) and the curve of op2 (its
cells are hashed by a Spark function) are held against brute force in tests.
"""

# The letters that are lower-cased, and the patterns of words.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str, lower: bool) -> str:
    value = f"coalesce({text}, '')"
    if lower:
        value = f"translate({value}, '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({value}, '{pattern}')"


#: Components of links(a, b): the smallest node each node reaches.
_COMPONENTS = """
  both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
  lowest AS (SELECT a, least(a, min(b)) AS low FROM reach GROUP BY a)"""

OP3 = f"""
WITH d AS (SELECT doc_id, {_words("text", _SPACED, True)} AS w FROM documents),
  t AS (SELECT doc_id, i, w[i] AS x, CASE WHEN i > 1 THEN w[i - 1] END AS u FROM d, unnest(range(1, len(w) + 1)) AS r(i)),
  c1 AS (SELECT x, count(*) AS n FROM t GROUP BY x),
  c2 AS (SELECT u, x, count(*) AS n FROM t WHERE u IS NOT NULL GROUP BY u, x),
  d1 AS (SELECT doc_id, x, count(*) AS n FROM t GROUP BY doc_id, x),
  d2 AS (SELECT doc_id, u, x, count(*) AS n FROM t WHERE u IS NOT NULL GROUP BY doc_id, u, x),
  total AS (SELECT count(*) AS n FROM t),
  v AS (
    SELECT t.doc_id, t.i, total.n - len(d.w) AS rest, c1.n - d1.n AS one, cu.n - du.n AS context, coalesce(c2.n - d2.n, 0) AS two
    FROM t JOIN d USING (doc_id) CROSS JOIN total JOIN c1 ON c1.x = t.x JOIN d1 ON d1.doc_id = t.doc_id AND d1.x = t.x
      LEFT JOIN c1 AS cu ON cu.x = t.u LEFT JOIN d1 AS du ON du.doc_id = t.doc_id AND du.x = t.u
      LEFT JOIN c2 ON c2.u = t.u AND c2.x = t.x LEFT JOIN d2 ON d2.doc_id = t.doc_id AND d2.u = t.u AND d2.x = t.x),
  s AS (
    SELECT doc_id,
      CASE WHEN two > 0 THEN ln(two) - ln(context)
        WHEN one > 0 THEN ln(one) - ln(rest) + CASE WHEN i > 1 THEN ln(0.4) ELSE 0 END
        ELSE -ln(rest + 1) + CASE WHEN i > 1 THEN 2 ELSE 1 END * ln(0.4) END AS score,
      CASE WHEN two > 0 OR (i = 1 AND one > 0) THEN 0 ELSE 1 END AS backed_off
    FROM v)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(sum(backed_off), 0)::BIGINT AS n_backed_off, round(coalesce(sum(score), 0.0), 4) AS log_score,
  round(sum(score) / len(d.w), 6) AS per_word
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id, d.w
"""

OP3_TRIGRAMS = f"""
WITH d AS (SELECT doc_id, {_words("text", _SPACED, True)} AS w FROM documents),
  t AS (SELECT doc_id, i, w[i] AS x, CASE WHEN i > 1 THEN w[i - 1] END AS u, CASE WHEN i > 2 THEN w[i - 2] END AS v FROM d, unnest(range(1, len(w) + 1)) AS r(i)),
  c1 AS (SELECT x, count(*) AS n FROM t GROUP BY x),
  c2 AS (SELECT u, x, count(*) AS n FROM t WHERE i > 1 GROUP BY u, x),
  c3 AS (SELECT v, u, x, count(*) AS n FROM t WHERE i > 2 GROUP BY v, u, x),
  d1 AS (SELECT doc_id, x, count(*) AS n FROM t GROUP BY doc_id, x),
  d2 AS (SELECT doc_id, u, x, count(*) AS n FROM t WHERE i > 1 GROUP BY doc_id, u, x),
  d3 AS (SELECT doc_id, v, u, x, count(*) AS n FROM t WHERE i > 2 GROUP BY doc_id, v, u, x),
  total AS (SELECT count(*) AS n FROM t),
  others AS (
    SELECT t.doc_id, t.i, total.n - len(d.w) AS rest, c1.n - d1.n AS one, cu.n - du.n AS before_one,
      coalesce(c2.n - d2.n, 0) AS two, cvu.n - dvu.n AS before_two, coalesce(c3.n - d3.n, 0) AS three
    FROM t JOIN d USING (doc_id) CROSS JOIN total
      JOIN c1 ON c1.x = t.x JOIN d1 ON d1.doc_id = t.doc_id AND d1.x = t.x
      LEFT JOIN c1 AS cu ON cu.x = t.u LEFT JOIN d1 AS du ON du.doc_id = t.doc_id AND du.x = t.u
      LEFT JOIN c2 ON c2.u = t.u AND c2.x = t.x LEFT JOIN d2 ON d2.doc_id = t.doc_id AND d2.u = t.u AND d2.x = t.x
      LEFT JOIN c2 AS cvu ON cvu.u = t.v AND cvu.x = t.u LEFT JOIN d2 AS dvu ON dvu.doc_id = t.doc_id AND dvu.u = t.v AND dvu.x = t.u
      LEFT JOIN c3 ON c3.v = t.v AND c3.u = t.u AND c3.x = t.x LEFT JOIN d3 ON d3.doc_id = t.doc_id AND d3.v = t.v AND d3.u = t.u AND d3.x = t.x),
  s AS (
    SELECT doc_id,
      CASE WHEN three > 0 THEN ln(three) - ln(before_two)
        WHEN two > 0 THEN ln(two) - ln(before_one) + (least(i, 3) - 2) * ln(0.4)
        WHEN one > 0 THEN ln(one) - ln(rest) + (least(i, 3) - 1) * ln(0.4)
        ELSE -ln(rest + 1) + least(i, 3) * ln(0.4) END AS score,
      CASE WHEN three > 0 OR (i = 2 AND two > 0) OR (i = 1 AND one > 0) THEN 0 ELSE 1 END AS backed_off
    FROM others)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(sum(backed_off), 0)::BIGINT AS n_backed_off, round(coalesce(sum(score), 0.0), 4) AS log_score,
  round(sum(score) / len(d.w), 6) AS per_word
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id, d.w
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {_words("text", _SPACED, False)} AS w FROM documents),
  windows AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS s FROM d, unnest(range(1, len(w) - 48)) AS r(i)),
  first_doc AS (SELECT s, min(doc_id) AS low FROM windows GROUP BY s),
  gone AS (SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN first_doc USING (s), range(0, 50) AS r(k) WHERE low < doc_id),
  words AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS r(p)),
  kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP5 = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
  links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND len(p.x) = len(q.x) AND p.vec_id < q.vec_id
    WHERE list_cosine_similarity(p.x, q.x) >= 0.98),{_COMPONENTS},
  n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN lowest ON lowest.a = vec_id
"""

OP6 = f"""
WITH d AS (SELECT doc_id, {_words("text", _ALNUM, True)} AS w FROM documents),
  b AS (SELECT item_id, {_words("text", _ALNUM, True)} AS w FROM benchmark),
  item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS s
    FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
  hits AS (
    SELECT DISTINCT doc_id, i, n, item_id
    FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM d, (SELECT DISTINCT n FROM item_windows) AS sizes, unnest(range(1, len(w) - n + 2)) AS r(i))
      JOIN item_windows USING (n, s)),
  n_hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hits, unnest(range(0, n)) AS r(k) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("text", _SPACED, True)} AS w FROM documents),
  shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS r(i) WHERE len(w) > 0),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  shared AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id < q.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)),{_COMPONENTS}
SELECT documents.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, documents.doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = documents.doc_id
"""

OP12 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda e: e IS NULL OR NOT isfinite(e))) = 0),
  s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

OP13 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
  drawn AS (
    SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
      ('0x' || h[25:32])::BIGINT AS h4
    FROM d),
  cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
  parts AS (SELECT *, substring(t, 1, i) AS p, substring(t, i + 1, j - i) AS m, substring(t, j + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

SQL = {
    "op3_backoff_scores": OP3,
    "op4_substrings": OP4,
    "op5_lattice_hashing": OP5,
    "op6_decontamination": OP6,
    "op9_jaccard_join": OP9,
    "op12_hard_negatives": OP12,
    "op13_fill_in_middle": OP13,
}

#: Of the queries that stand beside those of each operator.
FURTHER_SQL = {"op3_trigram_scores": OP3_TRIGRAMS}
