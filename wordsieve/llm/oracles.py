"""SQL that checks the queries of this subpackage, for those that SQL can express."""

from __future__ import annotations

from wordsieve.llm import chat as C
from wordsieve.llm import line_rules as L
from wordsieve.llm import ranked as R
from wordsieve.llm import variants as V

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
NORMAL = r"trim(regexp_replace(regexp_replace(lower({}), '[\x09-\x0D ]+', ' ', 'g'), '[0-9]+', '0', 'g'))"

LINE_RULES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, {WORDS.format('t')} AS ws FROM d),
win AS (
  SELECT r, i, list_slice(ws, i, i + {L.WINDOW - 1}) AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {L.WINDOW - 2})) AS i FROM w) s
),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) s WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {L.WINDOW})) AS p FROM dup) s GROUP BY r),
ln AS (
  SELECT r, source, line, {NORMAL.format('line')} AS norm, len({WORDS.format('line')}) AS n
  FROM (SELECT r, source, unnest(string_split(t, chr(10))) AS line FROM d) s
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
),
dl AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY r),
freq AS (SELECT source, norm FROM ln GROUP BY source, norm HAVING count(DISTINCT r) > {L.DOCS_PER_LINE}),
gone AS (
  SELECT r, sum(ln.n) AS n FROM ln JOIN freq ON ln.norm = freq.norm AND ln.source IS NOT DISTINCT FROM freq.source GROUP BY r
),
f AS (
  SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(length(array_to_string(w.ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dl.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dl USING (r) LEFT JOIN gone USING (r)
),
b AS (SELECT *, n_words < {L.LEAST_WORDS} OR 100 * n_repeat_words > {L.REPEATED_PERCENT} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 100 * (n_words - n_removed_words) >= {L.LEFT_PERCENT} * n_words AS kept FROM b
"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 8) AS BIGINT) AS u
  FROM documents
),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM s),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM p),
l AS (
  SELECT *, (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source IS NULL, encode(source))
),
c AS (SELECT *, rest * weight >= cap * open AS at_cap FROM l),
lev AS (SELECT rest, open FROM c WHERE NOT at_cap ORDER BY open DESC LIMIT 1),
t AS (
  SELECT c.source, source_size,
    CASE WHEN at_cap THEN CAST(cap AS DOUBLE) ELSE CAST(weight * lev.rest AS DOUBLE) / CAST(lev.open AS DOUBLE) END AS target
  FROM c LEFT JOIN lev ON TRUE
),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
g AS (SELECT source, u // 1048576 AS slice, sum(size) AS words FROM d GROUP BY ALL),
h AS (
  SELECT r.source, slice, target - whole * source_size AS wanted,
    abs(sum(words) OVER (PARTITION BY r.source ORDER BY slice) - (target - whole * source_size)) AS gap
  FROM g JOIN r ON g.source IS NOT DISTINCT FROM r.source
),
b AS (SELECT source, wanted, min(gap) AS gap FROM h GROUP BY source, wanted),
k AS (
  SELECT b.source, CASE WHEN b.gap < b.wanted THEN min(h.slice) + 1 ELSE 0 END AS slices
  FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.source AND b.gap = h.gap GROUP BY b.source, b.gap, b.wanted
)
SELECT doc_id, size, source_size, target,
  CAST(whole + CASE WHEN u // 1048576 < slices THEN 1 ELSE 0 END AS INTEGER) AS copies,
  CAST((whole + CASE WHEN u // 1048576 < slices THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""

# crc32 by its table, a byte at a time; DuckDB has no function for it.
VARIANTS = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{V.RUN}')) AS run
    FROM documents) s GROUP BY ALL
),
bytes AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
crc AS (
  SELECT run, n, xor(list_reduce(
    list_concat([4294967295], list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
    lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)), 4294967295) AS h
  FROM bytes, crc_table
),
kept AS (
  SELECT CASE WHEN h % {V.DAMAGED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crc
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM kept WHERE length(word) >= {V.LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {V.LEAST_COUNT}
),
gaps AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words) s),
shorter AS (SELECT DISTINCT g.word AS a, g.n AS an, w.word AS b, w.n AS bn FROM gaps g JOIN words w ON g.v = w.word),
links AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION ALL SELECT a, an, b, bn FROM shorter UNION ALL SELECT b, bn, a, an FROM shorter
),
best AS (SELECT word, n, count(*) AS n_near, max(near_n) AS most FROM links GROUP BY word, n),
first AS (SELECT l.word, min(encode(l.near)) AS near FROM links l JOIN best b ON l.word = b.word AND l.near_n = b.most GROUP BY l.word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= {V.FORM_RATIO} * w.n THEN decode(f.near) END AS form,
    CASE WHEN b.most >= {V.FORM_RATIO} * w.n THEN b.most END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN first f ON w.word = f.word
),
steps AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.at = f.word WHERE f.form IS NOT NULL
),
ends AS (SELECT s.word, s.at AS root FROM steps s JOIN forms f ON s.at = f.word WHERE f.form IS NULL)
SELECT f.word, form, root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM forms f JOIN ends e ON f.word = e.word
"""

ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
ODD_TURN = f"'{C.END}{C.START}assistant ok'"

CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', {ODD_TURN} UNION ALL SELECT -1, 1, '{C.REPLY}', {ODD_TURN}
),
p AS (
  SELECT *, length({ESCAPED.format(r"replace(replace(r, '\', '\\'), chr(10), '\n')")}) + length({ESCAPED.format('x')}) + {len(C.START) + len(C.END) + 2} AS chars FROM t
),
c AS (
  SELECT *, sum(chars) OVER (o ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS many
  FROM p WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(r), encode(x))
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (WHERE r = '{C.REPLY}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE r = '{C.REPLY}'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE r = '{C.REPLY}' OR i = many) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE r = '{C.REPLY}') AS n_examples
FROM c GROUP BY conv_id
"""

TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS ts FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM n),
q AS (SELECT DISTINCT item_id, unnest({TERMS}) AS t FROM benchmark),
tf AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) u WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t) f, s
),
g AS (
  SELECT q.item_id, n.r, n.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n.n * docs) // length)))) AS BIGINT) AS score
  FROM tf JOIN n ON tf.r = n.r JOIN w ON tf.t = w.t JOIN q ON tf.t = q.t, s GROUP BY ALL
),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM g WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= {R.TOP}
"""

ORACLES = {
    "op6_line_rules": LINE_RULES,
    "op9_mix_sources": MIXING,
    "op11_spelling_variants": VARIANTS,
    "op12_chat_examples": CHAT,
    "op13_ranked_search": RANKED,
}
