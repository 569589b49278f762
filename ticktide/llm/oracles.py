"""SQL for those queries of this subpackage that SQL can express."""

#: Escaping as in the chat template: a backslash after the first character of a control string.
_ESCAPED = r"regexp_replace({0}, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')"

#: A table of the 256 remainders of the checksum's polynomial, as list t; then the checksum of an ASCII string.
_CRC = """crc AS (SELECT list(v ORDER BY i) AS t FROM (WITH RECURSIVE b AS (SELECT i, i AS v, 0 AS k FROM range(256) r(i) UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM b WHERE k < 8) SELECT i, v FROM b WHERE k = 8))"""
_CRC_OF = "xor(list_reduce([CAST(x AS BIGINT) FOR x IN {0}], lambda a, x: xor(a // 256, t[xor(a, x) % 256 + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"

ORACLES: dict[str, str] = {
    "op3_chat": f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text)),
r AS (SELECT *, length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + length('<s>[INST] ') + length(' [/INST]') + length('</s>') AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS turns FROM t),
c AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM r),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256, coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '') AS loss, sum(CASE WHEN role = 'assistant' OR i = turns THEN upto END) AS formatted_chars, sum(CASE WHEN role = 'assistant' OR i = turns THEN 1 END) AS n_examples FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars, CAST(n_examples AS BIGINT) AS n_examples FROM g""",
    # a word lies in a repeat of n or more words exactly if it lies in an n-word window found twice
    "op10_quality": r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT doc_id, ws, len(ws) AS n, unnest(generate_series(1, len(ws))) AS i FROM w),
k AS (SELECT doc_id, i, n, CASE WHEN i + 4 <= n THEN array_to_string(ws[i:i + 4], ' ') END AS a, CASE WHEN i + 11 <= n THEN array_to_string(ws[i:i + 11], ' ') END AS b, CASE WHEN i + 200 <= n THEN sha256(array_to_string(ws[i:i + 200], ' ')) END AS c FROM p),
f AS (SELECT doc_id, i, CASE WHEN a IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a) > 1 THEN 1 ELSE 0 END AS a, CASE WHEN b IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, b) > 1 THEN 1 ELSE 0 END AS b, CASE WHEN c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, c) > 1 THEN 1 ELSE 0 END AS c FROM k),
v AS (SELECT doc_id, max(a) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS a, max(b) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS b, c FROM f),
g AS (SELECT doc_id, sum(a) AS ra, sum(b) AS rb, max(c) AS c FROM v GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d), lw AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
r AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines, CAST(coalesce(ra, 0) AS BIGINT) AS n_repeat_words, CASE WHEN len(ws) > 0 THEN coalesce(rb, 0) * 1.0 / len(ws) ELSE 0 END AS covered, coalesce(c, 0) AS over_longest FROM w LEFT JOIN g ON w.doc_id = g.doc_id LEFT JOIN lw ON w.doc_id = lw.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(covered, 9) AS covered, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND covered <= 0.15 AND over_longest = 0 AS kept FROM r""",
    # every run of 50 or more words is a union of the shortest such runs that begin or end at one of its lines
    "op7_linededup": r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), p AS (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM d),
w AS (SELECT doc_id, i, ls, ls[i] AS line, len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) AS n FROM p), c AS (SELECT doc_id, i, n, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM w),
r AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 50 GROUP BY a.doc_id, a.i), l AS (SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 50 GROUP BY b.doc_id, b.i),
u AS (SELECT * FROM r UNION SELECT * FROM l), k AS (SELECT u.doc_id, s, e, sha256(array_to_string(ls[s:e], chr(10))) AS key FROM u JOIN d ON u.doc_id = d.doc_id), f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, s) AS no FROM k),
g AS (SELECT DISTINCT c.doc_id, c.i FROM f JOIN c ON f.doc_id = c.doc_id AND c.i BETWEEN f.s AND f.e WHERE no > 1)
SELECT w.doc_id, coalesce(string_agg(CASE WHEN g.i IS NULL THEN line END, chr(10) ORDER BY w.i), '') AS text, count(*) AS n_lines, count(g.i) AS n_removed FROM w LEFT JOIN g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id""",
    # states and edits by recursion over the rows of all conversations, least (cost, letters) of each state
    "op13_repair": f"""WITH RECURSIVE {_CRC},
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT o.*, {_CRC_OF.format("[ascii(y) FOR y IN string_split(key, '')]")} % 20 AS fault FROM o, crc),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS c FROM h WHERE fault <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS c0, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare FROM d),
m AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM n),
f AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(c0) OVER (PARTITION BY conv_id ORDER BY i) || c0 AS pair FROM m),
g AS (SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
ins AS (SELECT * FROM (VALUES (0, 0, 0, '', ''), (0, 2, 5, 'I', 'user:'), (0, 3, 10, 'II', 'user:' || chr(10) || 'assistant:'), (1, 1, 0, '', ''), (1, 2, 5, 'I', 'user:'), (1, 3, 10, 'II', 'user:' || chr(10) || 'assistant:'), (2, 2, 0, '', ''), (2, 3, 5, 'I', 'assistant:'), (2, 2, 10, 'II', 'assistant:' || chr(10) || 'user:'), (3, 3, 0, '', ''), (3, 2, 5, 'I', 'user:'), (3, 3, 10, 'II', 'user:' || chr(10) || 'assistant:')) v(s, m, cost, word, said)),
ed AS (SELECT * FROM (VALUES (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''), (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (3, 2, 'K', 'u'), (2, 3, 'K', 'a'), (0, 2, 'R', 'user'), (1, 2, 'R', 'user'), (3, 2, 'R', 'user'), (2, 3, 'R', 'assistant')) v(m, t, e, x)),
v AS (SELECT g.conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS word, '' AS said FROM g
UNION ALL SELECT conv_id, i, s, b.cost, b.word, b.said FROM (SELECT v.conv_id, f.i, ed.t AS s, min(struct_pack(cost := v.cost + ins.cost + CASE e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END, word := v.word || ins.word || e, said := v.said || CASE WHEN v.said <> '' AND ins.said <> '' THEN chr(10) ELSE '' END || ins.said || CASE WHEN e = 'D' THEN '' ELSE CASE WHEN v.said || ins.said <> '' THEN chr(10) ELSE '' END || CASE e WHEN 'K' THEN role ELSE x END || ':' || text END)) AS b
FROM v JOIN f ON v.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = v.i + 1 JOIN ins ON ins.s = v.s JOIN ed ON ed.m = ins.m WHERE e = 'D' OR fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR c0 = x) GROUP BY v.conv_id, f.i, ed.t)),
z AS (SELECT v.conv_id, min(struct_pack(cost := v.cost + ins.cost, word := v.word || ins.word, said := v.said || CASE WHEN v.said <> '' AND ins.said <> '' THEN chr(10) ELSE '' END || ins.said)) AS b FROM v JOIN g ON v.conv_id IS NOT DISTINCT FROM g.conv_id AND v.i = g.rows JOIN ins ON ins.s = v.s AND ins.m IN (0, 3) GROUP BY v.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(z.b.cost, 0) AS cost, coalesce(z.b.word, '') AS audit, sha256(coalesce(z.b.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN z ON c.conv_id IS NOT DISTINCT FROM z.conv_id""",
    # near words share what is left when one code point is taken from one or from both at the same place
    "op12_spelling": f"""WITH RECURSIVE {_CRC},
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
c AS (SELECT run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY doc_id, run),
k AS (SELECT run, n, {_CRC_OF.format("[('0x' || substr(h, 2 * i + 1, 2))::INTEGER FOR i IN range(length(h) // 2)]")} AS h FROM c, crc),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM k) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
v AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM w)),
p AS (SELECT DISTINCT a.word, b.word AS near, b.n FROM v a JOIN v b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word UNION SELECT v.word, w.word, w.n FROM v JOIN w ON v.rest = w.word UNION SELECT w.word, v.word, v.n FROM v JOIN w ON v.rest = w.word),
b AS (SELECT word, count(*) AS n_near, min(struct_pack(minus := -n, near := near)) AS best FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.best.minus >= 10 * w.n THEN b.best.near END AS form, CASE WHEN -b.best.minus >= 10 * w.n THEN -b.best.minus END AS form_n FROM w LEFT JOIN b ON w.word = b.word),
u AS (SELECT word, word AS o, 0 AS i FROM f UNION ALL SELECT u.word, f.form, i + 1 FROM u JOIN f ON u.o = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(o, i) AS root FROM u GROUP BY word) e ON e.word = f.word""",
    # every pair compared; the search by hashing finds all pairs of these tables
    "op11_embdedup": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings), k AS (SELECT * FROM v WHERE len(e) > 0 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN e]) AND list_bool_or([x <> 0 FOR x IN e])),
l AS (SELECT a.r, b.r AS o, b.vec_id FROM k a JOIN k b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9), c AS (SELECT r, r AS o FROM v UNION SELECT c.r, l.o FROM c JOIN l ON c.o = l.r),
m AS (SELECT c.r, min(v.vec_id) AS component_id FROM c JOIN v ON c.o = v.r GROUP BY c.r)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.r = v.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN m ON v.r = m.r""",
}
