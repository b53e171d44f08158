"""DuckDB SQL of the opN_* queries that SQL can express."""

#: CRC-32 of a text's UTF-8 bytes, unsigned; {0} is the text.
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(octet_length(encode({0}))), lambda k: ('0x' || substr(hex(encode({0})), 2 * k + 1, 2))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

ORACLE_SQL = {
    "op1_topk_search": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE a.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) x WHERE rank <= 5
""",
    "op3_chat_format": r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) x(t, r)),
escaped AS (SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS shown_role, replace(replace(text, '\', '\\'), '<|', '<\|') AS shown FROM given),
ordered AS (
    SELECT *, row_number() OVER w AS k, lag(shown_role) OVER w IS DISTINCT FROM shown_role OR row_number() OVER w = 1 AS opens
    FROM escaped WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, shown_role, shown))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(shown) + CASE WHEN opens THEN length(shown_role) + length('<|turn|><|says|><|end|>') ELSE length('<|more|>') END)::BIGINT AS formatted_chars
FROM ordered GROUP BY conv_id
""",
    "op7_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
bags AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS bag FROM words),
named AS (SELECT doc_id, bag, len(bag) AS n, md5(array_to_string(bag, chr(10))) AS sid FROM bags),
sets AS (SELECT sid, any_value(bag) AS bag, any_value(n) AS n, min(doc_id) AS first FROM named WHERE n > 0 GROUP BY sid),
grams AS (SELECT sid, n, unnest(bag) AS gram FROM sets),
pairs AS (
    SELECT a.sid AS a, b.sid AS b, a.n AS n_a, b.n AS n_b, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.sid <> b.sid
    WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 90 * (n_a + n_b - shared)),
reach AS (SELECT sid AS a, sid AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT r.a AS sid, min(s.first) AS component_id FROM reach r JOIN sets s ON s.sid = r.b GROUP BY r.a)
SELECT d.doc_id, d.n AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id FROM named d LEFT JOIN least_of l ON l.sid = d.sid AND d.n > 0
""",
    "op10_line_dedup": r"""
WITH split AS (SELECT doc_id, str_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
lines AS (
    SELECT doc_id, i, n, line, regexp_matches(line, '[^ \t\n\x0b\f\r]') AS filled, len(regexp_extract_all(line, '[^ \t\n\x0b\f\r]+')) > 50 AS long,
           lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS next
    FROM (SELECT doc_id, len(lines) AS n, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM split)),
spans AS (
    SELECT doc_id, i, 2 AS k, n, line || chr(10) || next AS body FROM lines WHERE next IS NOT NULL AND regexp_matches(line || next, '[^ \t\n\x0b\f\r]')
    UNION ALL SELECT doc_id, i, 1, n, line FROM lines WHERE long),
ranked AS (SELECT *, first_value((doc_id, i, n)) OVER (PARTITION BY k, body ORDER BY doc_id, i) AS f FROM spans),
cut AS (
    SELECT DISTINCT doc_id, i + o AS i FROM (
        SELECT doc_id, i, k FROM ranked WHERE (doc_id <> f[1] OR i >= f[2] + k) AND NOT (k = 1 AND n = 1 AND f[3] = 1)) c, (SELECT unnest([0, 1]) AS o) x WHERE o < k),
marked AS (
    SELECT l.*, c.i IS NOT NULL AS gone, NOT filled AS empty, count(c.i) OVER (PARTITION BY l.doc_id ORDER BY l.i) AS passed, count(c.i) OVER (PARTITION BY l.doc_id) AS cuts
    FROM lines l LEFT JOIN cut c ON c.doc_id = l.doc_id AND c.i = l.i),
gaps AS (
    SELECT doc_id, passed, cuts, bool_and(empty) AS empty, min(i) AS lo, max(i) AS hi FROM marked WHERE NOT gone GROUP BY doc_id, passed, cuts),
parting AS (
    SELECT g.doc_id, g.passed FROM gaps g JOIN marked a ON a.doc_id = g.doc_id AND a.i = g.lo - 1 JOIN marked b ON b.doc_id = g.doc_id AND b.i = g.hi + 1
    WHERE g.empty AND g.passed > 0 AND g.passed < g.cuts AND a.empty AND b.empty),
kept AS (
    SELECT m.doc_id, string_agg(m.line, chr(10) ORDER BY m.i) AS text, count(*) AS n FROM marked m LEFT JOIN parting p ON p.doc_id = m.doc_id AND p.passed = m.passed
    WHERE NOT m.gone AND p.doc_id IS NULL GROUP BY m.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(len(s.lines), 0)::BIGINT AS n_lines,
       (coalesce(len(s.lines), 0) - coalesce(k.n, 0))::BIGINT AS n_removed_lines
FROM documents d LEFT JOIN split s ON s.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
""",
    "op4_warc_archive": """
WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT body, min(page_id) AS first FROM t WHERE octet_length(encode(body)) >= 100 GROUP BY body)
SELECT t.page_id, octet_length(encode(t.body))::BIGINT AS payload_bytes, sha256(t.body) AS payload_digest,
       CASE WHEN t.page_id > g.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN t.page_id > g.first THEN g.first END AS refers_to
FROM t LEFT JOIN g ON t.body = g.body
""",
    "op9_exact_dedup": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS spot FROM conversations),
hit AS (SELECT *, """ + CRC32.format("spot") + r""" % 20 AS fault FROM raw),
damaged AS (
    SELECT conv_id, turn, c.i AS copy, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hit, (SELECT unnest([1, 2]) AS i) c WHERE fault <> 0 AND (c.i = 1 OR fault = 3)),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
           right(rtrim(text, E' \t\n\x0b\x0c\r'), 1) AS closing, left(role, 1) AS initial
    FROM damaged),
rows AS (
    SELECT *, closing = '' AS blank, closing <> '' AND seen AS dup, closing <> '' AND NOT seen AND closing NOT IN ('.', '!', '?') AS unfinished,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
    FROM numbered),
ids AS (
    SELECT i.conv_id, coalesce(max(r.turn) - min(r.turn) + 1 - count(DISTINCT r.turn), 0) AS gaps, count_if(r.blank) AS blank, count_if(r.dup) AS duplicate,
           count_if(r.unfinished) AS truncated, coalesce(count_if(r.illegal), 0) AS illegal, count(r.i) AS n
    FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM i.conv_id GROUP BY i.conv_id),
jumps(state, ins, onto) AS (VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (2, '', 2), (2, 'I', 3), (3, '', 3), (3, 'I', 2)),
edits AS (
    SELECT r.conv_id, r.i, s.state, e.name, CASE e.name WHEN 'D' THEN s.state WHEN 'R' THEN s.spoken ELSE CASE r.initial WHEN 's' THEN 1 ELSE s.spoken END END AS onto,
           CASE e.name WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN e.name <> 'D' AND r.unfinished THEN 1 ELSE 0 END AS price
    FROM rows r, (VALUES (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')) s(state, spoken, wanted), (VALUES ('D'), ('R'), ('K')) e(name)
    WHERE e.name = 'D' OR NOT r.blank AND NOT r.dup AND (e.name = 'R' OR r.initial = s.wanted OR r.initial = 's' AND s.state = 0)),
path AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit FROM ids
    UNION ALL
    SELECT conv_id, i, state, cost, audit FROM (
        SELECT p.conv_id, e.i, e.onto AS state, p.cost + 2 * length(j.ins) + e.price AS cost, p.audit || j.ins || e.name AS audit
        FROM path p JOIN jumps j ON j.state = p.state JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.state = j.onto)
    QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
done AS (
    SELECT ids.*, p.cost + 2 * length(j.ins) AS cost, p.audit || j.ins AS audit
    FROM ids JOIN path p ON p.conv_id IS NOT DISTINCT FROM ids.conv_id AND p.i = ids.n JOIN jumps j ON j.state = p.state WHERE j.onto IN (0, 3)
    QUALIFY row_number() OVER (PARTITION BY ids.conv_id ORDER BY p.cost + 2 * length(j.ins), p.audit || j.ins) = 1),
steps AS (
    SELECT conv_id, k, audit[k] AS name, length(replace(audit[:k], 'I', '')) AS i, length(replace(audit[:k], 'D', '')) AS place
    FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM done)),
kept AS (
    SELECT s.*, r.role, r.text, max(CASE WHEN s.place = 1 AND s.name = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS systems
    FROM steps s LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i AND s.name <> 'I' WHERE s.name <> 'D'),
said AS (
    SELECT conv_id, string_agg(CASE WHEN name = 'K' THEN role WHEN (place - systems) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS lines
    FROM kept GROUP BY conv_id)
SELECT d.conv_id, d.gaps, d.blank, d.duplicate, d.truncated, d.illegal, d.cost::BIGINT AS cost, d.audit, sha256(coalesce(s.lines, '')) AS repaired_sha256
FROM done d LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM d.conv_id
""",
    "op13_spelling_variants": """
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS times
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{5,}')) AS run FROM documents)
    GROUP BY doc_id, run),
hashed AS (SELECT *, """ + CRC32.format("(doc_id || ':' || run)") + """ AS h FROM runs),
cut AS (SELECT times, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
holes AS (SELECT word, n, spot, left(word, spot - 1) || substr(word, spot + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS spot FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.spot = b.spot AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
named AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n,
           CASE WHEN b.top >= 2 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.n = b.top) END AS form
    FROM words w LEFT JOIN best b ON b.word = w.word),
path AS (
    SELECT word, word AS root, 0 AS far FROM named
    UNION ALL SELECT p.word, n.form, p.far + 1 FROM path p JOIN named n ON n.word = p.root WHERE n.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, far) AS root FROM path GROUP BY word)
SELECT n.word, n.form, e.root, n.n, n.n_near, n.form_n FROM named n JOIN ends e ON e.word = n.word
""",
}
