"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Windows of at most 1024 tokens, 128 of them repeated; 8 characters of template for each turn.
ORACLE["op8_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), numbered AS (
  SELECT *, len(regexp_extract_all(text, '[^\t\n\x0B\f\r ]+')) + 4 AS size,
    length(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g')) AS written,
    row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    first(role) OVER w AS role1, first(text) OVER w AS text1
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), opened AS (
  SELECT *, role1 = 'system' AND n > 1 AS opens,
    CASE WHEN role1 = 'system' AND n > 1
         THEN len(regexp_extract_all(text1, '[^\t\n\x0B\f\r ]+')) + 4 ELSE 0 END AS system_size,
    CASE WHEN role1 = 'system' AND n > 1
         THEN length(regexp_replace(text1, '<(\\*/?s>)', '<\\\1', 'g')) + 8 + 6 ELSE 0 END AS system_chars
  FROM numbered
), spans AS (
  SELECT *, greatest(1, (1024 - system_size - 128) // 2) AS quota,
    coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM opened WHERE NOT (opens AND pos = 1) WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), slots AS (
  SELECT *, start // quota AS slot,
    sum(CASE WHEN size > quota THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS large
  FROM spans
), placed AS (
  SELECT *, max(start + size) OVER (PARTITION BY conv_id, slot, large) AS stop,
    dense_rank() OVER (PARTITION BY conv_id ORDER BY slot, large) AS win
  FROM slots
), own AS (
  SELECT conv_id, win, sum(size) AS size, sum(written + length(role) + 8) AS chars,
    any_value(system_size) AS system_size, any_value(system_chars) AS system_chars
  FROM placed GROUP BY conv_id, win
), past AS (
  SELECT conv_id, win + 1 AS win, sum(size) AS size, sum(written + length(role) + 8) AS chars
  FROM placed WHERE stop - start <= 128 GROUP BY conv_id, win
), formatted AS (
  SELECT o.conv_id, sum(o.chars + o.system_chars +
    CASE WHEN o.size + coalesce(p.size, 0) + o.system_size <= 1024 THEN coalesce(p.chars, 0) ELSE 0 END) AS formatted_chars
  FROM own o LEFT JOIN past p ON o.conv_id IS NOT DISTINCT FROM p.conv_id AND o.win = p.win GROUP BY o.conv_id
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '')) AS loss_sha256
  FROM numbered GROUP BY conv_id
)
SELECT w.conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(loss_chars AS BIGINT) AS loss_chars,
  loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole w JOIN formatted f ON w.conv_id IS NOT DISTINCT FROM f.conv_id
"""

ORACLE["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id != b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(node, least) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.b, r.least FROM reach r JOIN links l ON r.node = l.a WHERE r.least < l.b
), found AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, f.component_id,
  e.vec_id = f.component_id AS kept
FROM embeddings e JOIN found f ON f.node = e.vec_id
"""

# Documents of one word sequence are compared once; shingles link documents by counting.
ORACLE["op4_minhash_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), class AS (SELECT w, min(doc_id) AS cid FROM words WHERE len(w) > 0 GROUP BY w),
shingle AS (
  SELECT DISTINCT cid, array_to_string(w[i:i + 4], ' ') AS s
  FROM class, unnest(range(1, greatest(2, len(w) - 3))) AS t(i)
), size AS (SELECT cid, count(*) AS n FROM shingle GROUP BY cid),
common AS (
  SELECT a.cid AS a, b.cid AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.cid < b.cid GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN size x ON x.cid = a JOIN size y ON y.cid = b
  WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(node, least) AS (
  SELECT cid, cid FROM class UNION SELECT e.b, r.least FROM reach r JOIN edge e ON r.node = e.a WHERE r.least < e.b
), found AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept
FROM words LEFT JOIN class USING (w) LEFT JOIN size USING (cid) LEFT JOIN found ON found.node = class.cid
"""

ORACLE["op5_decontamination"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, array_to_string(w[i:i + 9], ' ') AS s, least(10, len(w)) AS k
  FROM item, unnest(range(1, greatest(2, len(w) - 8))) AS t(i) WHERE len(w) > 0
), place AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM doc, (SELECT DISTINCT k FROM win), unnest(range(1, len(w) - k + 2)) AS t(i)
), hit AS (SELECT doc_id, i, win.k AS k, item FROM place JOIN win ON place.s = win.s AND place.k = win.k),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op13_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents
), num AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM cut
), part AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
         THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM num
), split AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM part
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form != 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form != 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM split
"""


def vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Brute force: every part against every entry, in long form. The rounds are written out."""
    def assigned(name: str, book: str) -> str:
        return f"""{name} AS (
  SELECT row, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.row, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d
    FROM piece p JOIN {book} b ON p.part = b.part AND p.place = b.place GROUP BY ALL) GROUP BY ALL
)"""

    ctes = [f"""v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""piece AS (
  SELECT row, (i - 1) // (len(e) // {parts}) AS part, (i - 1) % (len(e) // {parts}) AS place, e[i] AS x
  FROM v, unnest(range(1, len(e) + 1)) AS t(i)
)""", f"book0 AS (SELECT row - 1 AS entry, part, place, x FROM piece WHERE row <= {entries})"]
    for k in range(rounds):
        ctes += [assigned(f"near{k}", f"book{k}"), f"""book{k + 1} AS (
  SELECT entry, part, place, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT n.entry, part, place, CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM piece p JOIN near{k} n USING (row, part) GROUP BY ALL) m USING (entry, part, place)
)"""]
    ctes += [assigned("near", f"book{rounds}"), """coded AS (
  SELECT row, string_agg(lower(printf('%02x', CAST(entry AS INTEGER))), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near GROUP BY row
)"""]
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM v JOIN coded USING (row)"""


ORACLE["op11_vector_codes"] = vector_codes_sql()

ORACLE["op12_substring_dedup"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS nth
  FROM doc, unnest(range(1, len(w) - 18)) AS t(i)
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS places FROM win, unnest(range(i, i + 20)) AS t(p) WHERE nth > 1 GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, k: NOT list_contains(coalesce(places, []), k)), ' ')) AS kept_sha256
FROM doc LEFT JOIN gone USING (doc_id)
"""
