"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

_PASSAGES = r"""WITH split AS (SELECT doc_id,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
runs AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM split WHERE len(w) >= 50),
hashed AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM runs),
firsts AS (SELECT h, min(doc_id) AS owner FROM hashed GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p
  FROM hashed JOIN firsts USING (h) WHERE owner < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM split),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_removed,
sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id) LEFT JOIN counts c USING (doc_id)"""

_NEAR_VECTORS = """WITH RECURSIVE fit AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.label = b.label AND len(a.e) = len(b.e)
  AND a.vec_id <> b.vec_id WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reached(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id),
least AS (SELECT id, min(root) AS root FROM reached GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, root = vec_id AS kept
FROM embeddings JOIN least ON id = vec_id LEFT JOIN counts ON a = vec_id"""


_LICENCES = r"""WITH split AS (SELECT row_number() OVER () AS uid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
templates(id, label, base, share, body, phrases) AS (VALUES
  (0, 'cc-by', true, 1.0::DOUBLE, 'cc by', []::VARCHAR[]),
  (1, 'gpl', true, 1.0, 'general public license', []),
  (2, 'reserved', true, 1.0, 'all rights reserved', []),
  (3, 'apache-2.0', false, 0.5, 'licensed under the apache license version 2 0', ['apache license', '2 0']),
  (4, 'bsd', false, 0.5, 'redistribution and use in source and binary forms with or without modification are permitted',
    ['redistribution and use', 'source and binary forms']),
  (5, 'cc-by-nc', false, 0.5, 'licensed under cc by nc 4 0', ['cc by nc']),
  (6, 'cc-by-sa', false, 0.5, 'licensed under cc by sa 4 0', ['cc by sa']),
  (7, 'cc0', false, 0.5, 'to the extent possible under law the author has waived all copyright and related or neighboring rights',
    ['waived all copyright']),
  (8, 'gpl-3.0', false, 0.5, 'this work is licensed under the gnu general public license version 3',
    ['gnu general public license', 'version 3']),
  (9, 'isc', false, 0.5, 'permission to use copy modify and or distribute this software for any purpose with or without fee',
    ['use copy modify', 'with or without fee']),
  (10, 'mit', false, 0.5, 'permission is hereby granted free of charge to any person obtaining a copy of this software',
    ['permission is hereby granted', 'free of charge']),
  (11, 'mpl-2.0', false, 0.5, 'this source code form is subject to the terms of the mozilla public license v 2 0',
    ['mozilla public license']),
  (12, 'unlicense', false, 0.5, 'this is free and unencumbered software released into the public domain',
    ['released into the public domain'])),
parts AS (SELECT id, unnest(string_split(body, ' ')) AS word, generate_subscripts(string_split(body, ' '), 1) - 1 AS spot FROM templates),
phrases AS (SELECT id, p, string_split(p, ' ') AS pw,
  len(string_split(trim(split_part(' ' || body || ' ', ' ' || p || ' ', 1)), ' ')) * (NOT starts_with(body, p))::INT AS spot
  FROM (SELECT id, body, unnest(phrases) AS p FROM templates)),
placed AS (SELECT uid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM split),
df AS (SELECT word, count(DISTINCT uid) AS docs FROM placed GROUP BY word),
weights AS (SELECT word, greatest(round(1000 * ln(((SELECT count(*) FROM split) + 1)::DOUBLE / (coalesce(docs, 0) + 1))), 1)::BIGINT AS weight
  FROM (SELECT DISTINCT word FROM parts) LEFT JOIN df USING (word)),
whole AS (SELECT id, sum(weight) AS whole FROM parts JOIN weights USING (word) GROUP BY id),
aligned AS (SELECT uid, id, pos - spot AS start, sum(weight) AS gained FROM placed JOIN parts USING (word) JOIN weights USING (word)
  GROUP BY ALL),
likely AS (SELECT uid, id, start, CAST(gained AS DOUBLE) / CAST(whole AS DOUBLE) AS found, label, base
  FROM aligned JOIN whole USING (id) JOIN templates USING (id) WHERE CAST(gained AS DOUBLE) / CAST(whole AS DOUBLE) >= share),
missing AS (SELECT DISTINCT uid, id, start FROM likely JOIN phrases USING (id) JOIN split USING (uid)
  WHERE NOT list_contains([start + spot + o >= 0 AND w[start + spot + o + 1 : start + spot + o + len(pw)] = pw FOR o IN [-2, -1, 0, 1, 2]], true)),
accepted AS (SELECT * FROM likely ANTI JOIN missing USING (uid, id, start)),
told AS (SELECT uid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  round(max(found), 6) AS score FROM accepted GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
coalesce(score, 0.0::DOUBLE) AS score FROM split LEFT JOIN told USING (uid)"""

_VARIANTS = r"""WITH RECURSIVE runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''),
  '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
lowered AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL),
octets AS (SELECT run, n, list_concat([ord(c) FOR c IN string_split(id || ':', '')], flatten([
  CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + ord(c) // 64, 128 + ord(c) % 64] END FOR c IN string_split(run, '')])) AS b FROM lowered),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_transform(b, lambda x: CAST(x AS BIGINT)), lambda h, x:
  list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda k, j: xor(k >> 1, 3988292384 * (k & 1)), xor(h, x)), CAST(4294967295 AS BIGINT))) AS h FROM octets),
lossy AS (SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM lossy WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS cut FROM (
  SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  WHERE length(a.word) = length(b.word)
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
  CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
steps(word, root) AS (SELECT word, word FROM formed UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL),
roots AS (SELECT s.word, s.root FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)"""

_FILL_MIDDLE = r"""WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
counted AS (SELECT doc_id, t, string_split(t, chr(10)) AS parts, [CAST('0x' || h[8 * k + 1 : 8 * k + 8] AS BIGINT) FOR k IN [0, 1, 2, 3]] AS h,
  CAST(length(t) - length(replace(t, chr(10), '')) + (t <> '' AND NOT ends_with(t, chr(10)))::INT AS BIGINT) AS n FROM cut),
placed AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
  WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM counted),
starts AS (SELECT *, CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(t) ELSE length(array_to_string(parts[1 : a], chr(10))) + 1 END AS x,
  CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(t) ELSE length(array_to_string(parts[1 : b], chr(10))) + 1 END AS y FROM placed),
texts AS (SELECT *, substr(t, 1, x) AS p, substr(t, x + 1, y - x) AS m, substr(t, y + 1) AS s FROM starts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(x AS BIGINT) END AS prefix_chars,
CASE WHEN form <> 'plain' THEN CAST(y - x AS BIGINT) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM texts"""


def llm_oracles() -> dict[str, str]:
    """SQL by query name; hashing, sampling, learned scores and tokenizers are beyond SQL."""
    return {
        "op3_repeated_passages": _PASSAGES, "op4_near_vectors": _NEAR_VECTORS, "op11_licence_scan": _LICENCES,
        "op12_spelling_variants": _VARIANTS, "op13_fill_middle": _FILL_MIDDLE,
    }
