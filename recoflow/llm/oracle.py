"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from recoflow.llm import phrase_automata as A
from recoflow.llm import repair as R
from recoflow.llm import spelling as P
from recoflow.llm import url_graph as U
from recoflow.llm import warc as W

OP4 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
w AS (SELECT payload_digest, max(page_id) AS original FROM r
      WHERE payload_bytes >= {W.MIN_REVISIT_BYTES} AND page_id IS NOT NULL GROUP BY 1)
SELECT r.page_id, payload_bytes, r.payload_digest,
       CASE WHEN r.page_id < original AND payload_bytes >= {W.MIN_REVISIT_BYTES} THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.page_id < original AND payload_bytes >= {W.MIN_REVISIT_BYTES} THEN original END AS refers_to
FROM r LEFT JOIN w ON r.payload_digest = w.payload_digest
"""

_URL = """
       translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


def _op8() -> str:
    rules = sorted(U.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')"
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in rules) + " END"
    says = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in rules) + " END"
    d = U.DAMPING
    rounds = "".join(f"""
g{i} AS (SELECT host, sum(t) AS t, sum(d) AS d FROM (
           SELECT e.dst AS host, k.trust * e.forward AS t, 0.0::DOUBLE AS d FROM w e JOIN k{i - 1} k ON e.src = k.host
           UNION ALL SELECT e.src, 0.0::DOUBLE, k.distrust * e.back FROM w e JOIN k{i - 1} k ON e.dst = k.host) GROUP BY host),
k{i} AS (SELECT s.host, CASE WHEN (SELECT count(*) FROM w) = 0 THEN s.trusted::DOUBLE
                ELSE {1 - d!r}::DOUBLE * s.trusted + {d!r}::DOUBLE * coalesce(g.t, 0) END AS trust,
           CASE WHEN (SELECT count(*) FROM w) = 0 THEN s.distrusted::DOUBLE
                ELSE {1 - d!r}::DOUBLE * s.distrusted + {d!r}::DOUBLE * coalesce(g.d, 0) END AS distrust
         FROM seeds s LEFT JOIN g{i} g USING (host)),""" for i in range(1, U.ROUNDS + 1))
    return f"""
WITH a AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, html, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM a),
c AS (SELECT page_id, html, {_URL.format(rest='rest')} AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
j AS (SELECT page_id, host, path, {rule} AS rule, {says} AS says FROM c),
f AS (SELECT host, unnest(regexp_extract_all(html, 'href\\s*=\\s*["'']?((?:https?:)?//[^"''\\s>]*)', 1, 'i')) AS href FROM c),
l AS (SELECT host AS src, {_URL.format(rest="substr(href, instr(href, '//') + 2)")} AS dst FROM f),
e AS (SELECT src, dst, count(*) AS links FROM l WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
w AS (SELECT src, dst, links / sum(links) OVER (PARTITION BY src) AS forward, links / sum(links) OVER (PARTITION BY dst) AS back FROM e),
n AS (SELECT host, CAST(2 * count(*) FILTER (says = 'allow') > count(*) AS INT) AS trusted,
             CAST(2 * count(*) FILTER (says = 'block') > count(*) AS INT) AS distrusted FROM j GROUP BY host),
seeds AS (SELECT host, max(trusted) AS trusted, max(distrusted) AS distrusted FROM (
            SELECT * FROM n UNION ALL SELECT src, 0, 0 FROM e UNION ALL SELECT dst, 0, 0 FROM e) GROUP BY host),
k0 AS (SELECT host, trusted::DOUBLE AS trust, distrusted::DOUBLE AS distrust FROM seeds),{rounds}
z AS (SELECT host, CASE WHEN trust + distrust > 0 AND round(distrust / (trust + distrust), 9) >= {U.THRESHOLD} THEN 'block' ELSE 'allow' END AS by_host FROM k{U.ROUNDS})
SELECT page_id, j.host, path, rule, coalesce(says, by_host) AS verdict FROM j LEFT JOIN z ON j.host = z.host
"""


# crc32 of a text's bytes, from its table of 256 remainders.
_CRC_TABLE = """crc AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen({s}) + 1),
         lambda k: ('0x' || substr(hex(encode({s})), 2 * k - 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1])))"""

OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS doc, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL),
low AS (SELECT doc, translate(run, '{P.UPPER}', '{P.LOWER}') AS run, count(*) AS c FROM runs WHERE length(run) >= {P.MIN_LENGTH} GROUP BY ALL),
summed AS (SELECT run, c, {_CRC.format(s='(doc || run)')} AS h FROM low, crc),
spelt AS (SELECT c, CASE WHEN h % {P.TYPO_RATE} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed),
w AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= {P.MIN_LENGTH} GROUP BY word HAVING sum(c) >= {P.MIN_COUNT}),
less AS (SELECT word, n, left(word, i - 1) || substr(word, i + 1) AS shorter, left(word, i - 1) || '*' || substr(word, i + 1) AS mask
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT a.word, b.word AS other, b.n FROM less a JOIN w b ON a.shorter = b.word
         UNION SELECT b.word, a.word, a.n FROM less a JOIN w b ON a.shorter = b.word
         UNION SELECT a.word, b.word, b.n FROM less a JOIN less b ON a.mask = b.mask AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n FROM near GROUP BY word),
known AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= {P.RATIO} * w.n THEN form END AS form,
                              CASE WHEN form_n >= {P.RATIO} * w.n THEN form_n END AS form_n FROM w LEFT JOIN best ON w.word = best.word),
chain AS (SELECT word, word AS root, form AS next FROM known
          UNION ALL SELECT chain.word, chain.next, known.form FROM chain JOIN known ON chain.next = known.word)
SELECT known.word, n, n_near, known.form, form_n, root FROM known JOIN chain ON known.word = chain.word WHERE chain.next IS NULL
"""

OP12 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::BIGINT, {A.NULL_ID}) AS id,
                               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
keyed AS (SELECT r, id, i, words[i] AS word, CASE WHEN i + {A.WINDOW - 1} <= len(words) THEN md5(array_to_string(words[i:i + {A.WINDOW - 1}], ' ')) END AS h
          FROM (SELECT r, id, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
least AS (SELECT h, min(id) AS id FROM keyed WHERE h IS NOT NULL GROUP BY h),
judged AS (SELECT r, i, word, max(CASE WHEN k.id > l.id THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i ROWS {A.WINDOW - 1} PRECEDING) AS gone
           FROM keyed k LEFT JOIN least l ON k.h = l.h),
kept AS (SELECT r, sum(gone)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS rest FROM judged GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r
"""

# Insertions that lead from one state to another, and the lines they add. States: the initial put out last ('' at the start).
_U, _A = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
_INSERTS = f"""(VALUES ('', '', '', ''), ('s', 's', '', ''), ('u', 'u', '', ''), ('a', 'a', '', ''), ('', 'u', 'I', {_U}), ('s', 'u', 'I', {_U}), ('a', 'u', 'I', {_U}),
         ('u', 'a', 'I', {_A}), ('', 'a', 'II', {_U} || {_A}), ('s', 'a', 'II', {_U} || {_A}), ('a', 'a', 'II', {_U} || {_A}), ('u', 'u', 'II', {_A} || {_U}))"""
OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
d AS (SELECT conv_id, turn, role, text, {_CRC.format(s='key')} % 20 AS x FROM k, crc),
r AS (SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN x = 1 THEN '' WHEN x = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN x = 3 THEN [1, 2] ELSE [1] END) AS copy FROM d WHERE x <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM r),
f AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
             NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
g AS MATERIALIZED (SELECT conv_id, turn, i, role, text, initial, blank, NOT blank AND seen AS duplicate, NOT blank AND NOT seen AND cut AS truncated,
                          i > 1 AND before || initial NOT IN ('su', 'ua', 'au') AS illegal FROM f),
edits AS (SELECT conv_id, i, NULL AS before, NULL AS after, 'D' AS letter, {R.DELETE} AS cost, '' AS line FROM g
          UNION ALL SELECT conv_id, i, b, a, 'K', CASE WHEN truncated THEN {R.TRUNCATED} ELSE 0 END, chr(10) || role || ':' || text
          FROM g JOIN (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')) v(b, a) ON initial = a WHERE NOT blank AND NOT duplicate
          UNION ALL SELECT conv_id, i, b, left(a, 1), 'R', {R.REROLE} + CASE WHEN truncated THEN {R.TRUNCATED} ELSE 0 END, chr(10) || a || ':' || text
          FROM g, (VALUES ('', 'user'), ('s', 'user'), ('a', 'user'), ('u', 'assistant')) v(b, a) WHERE NOT blank AND NOT duplicate),
moves AS MATERIALIZED (SELECT e.conv_id, e.i, v.p AS before, coalesce(e.after, v.q) AS after, v.letters || e.letter AS letters,
                              e.cost + {R.INSERT} * length(v.letters) AS cost, v.lines || e.line AS lines
                       FROM edits e JOIN {_INSERTS} v(p, q, letters, lines) ON e.letter = 'D' OR e.before = v.q),
counts AS MATERIALIZED (SELECT c.conv_id, count(g.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                  count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
           FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY c.conv_id),
path AS (SELECT conv_id, 0::BIGINT AS i, '' AS state, 0::BIGINT AS cost, '' AS audit, '' AS body FROM counts
         UNION ALL
         SELECT conv_id, i, state, min(cost), arg_min(audit, lpad(cost::VARCHAR, 12, '0') || audit), arg_min(body, lpad(cost::VARCHAR, 12, '0') || audit)
         FROM (SELECT p.conv_id, m.i, m.after AS state, p.cost + m.cost AS cost, p.audit || m.letters AS audit, p.body || m.lines AS body
               FROM path p JOIN moves m ON p.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = p.i + 1 AND m.before = p.state) GROUP BY conv_id, i, state),
ends AS (SELECT c.conv_id, p.cost + {R.INSERT} * length(v.letters) AS cost, p.audit || v.letters AS audit, p.body || v.lines AS body
         FROM counts c JOIN path p ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = c.n
         JOIN {_INSERTS} v(p, q, letters, lines) ON p.state = v.p AND (v.q = 'a' OR v.p = '' AND v.q = '')),
best AS (SELECT conv_id, min(cost) AS cost, arg_min(audit, lpad(cost::VARCHAR, 12, '0') || audit) AS audit, arg_min(body, lpad(cost::VARCHAR, 12, '0') || audit) AS body
         FROM ends GROUP BY conv_id)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, b.cost::BIGINT AS cost, audit, sha256(substr(body, 2)) AS repaired_sha256
FROM counts c JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""

SQL: dict[str, str] = {"op4_warc": OP4, "op8_url_graph": _op8(), "op11_count_trie": OP11, "op12_phrase_automata": OP12, "op13_cyk_repair": OP13}
