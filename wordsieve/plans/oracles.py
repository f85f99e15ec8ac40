"""SQL over the same tables that gives the result each query must have."""

from __future__ import annotations

SPACELESS = "".join(f"\\p{{{name}}}" for name in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
# A run of letters of alphabets, or one of the scripts without blanks.
LETTER = rf"(?:[^\P{{L}}{SPACELESS}]|[\p{{M}}\p{{N}}])"
TOKEN = f"(?:{LETTER}+|[{SPACELESS}]+)"
EDGES = r"'^[\x00-\x20]+|[\x00-\x20]+$'"
INSULTS = (
    "('trash'), ('idiot'), ('clown'), ('scum'), ('worthless'), ('moron'), ('pathetic'), ('loser'), ('stupid'), ('disgusting')"
)


def trim(text: str) -> str:
    return f"regexp_replace({text}, {EDGES}, '', 'g')"


def ascii_marks(text: str) -> str:
    """The marks every profile removes."""
    step = f"replace(replace(replace({text}, '@', ''), '?', ''), '!', '')"
    return rf"replace(replace(replace({step}, '//', ''), '\', ''), '&', '')"


def cjk_marks(text: str) -> str:
    return f"replace(replace(replace(replace({text}, '？', ''), '】', ''), '”', ''''), '“', '''')"


def clean_filter(text: str) -> str:
    return trim(f"replace({ascii_marks(text)}, ' ', '')")


def clean_filter_cjk(text: str) -> str:
    return trim(cjk_marks(f"replace({ascii_marks(text)}, ' ', '')"))


def clean_train(text: str) -> str:
    return trim(cjk_marks(f"replace({ascii_marks(text)}, '%', '')"))


def clean_stream(text: str) -> str:
    return trim(cjk_marks(ascii_marks(text)))


def clean_ascii(text: str) -> str:
    return trim(ascii_marks(text))


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{TOKEN}')"


def bucket(term: str, n: int) -> str:
    return f"(('0x' || substr(md5({term}), 1, 8))::BIGINT % {n})"


def part(key: str) -> str:
    return f"CASE WHEN {bucket(key, 100)} < 80 THEN 'train' ELSE 'test' END"


TRAIN_TOKENS = tokens(clean_train("text"))
INSULT = f"insult(word) AS (VALUES {INSULTS})"
BENCH = f"bench AS (SELECT DISTINCT word FROM (SELECT unnest({tokens('text')}) AS word FROM benchmark))"
CONV = f"conv AS (SELECT DISTINCT word FROM (SELECT unnest({tokens('text')}) AS word FROM conversations))"
DOCWORD = f"""docword AS (
  SELECT DISTINCT word FROM (SELECT unnest({TRAIN_TOKENS}) AS word FROM documents) WHERE length(word) > 1)"""
WORDLEX = f"""{INSULT}, {DOCWORD},
wordlex AS (SELECT word FROM docword WHERE substr(md5(word), 1, 1) BETWEEN '0' AND '3' UNION SELECT word FROM insult)"""
LABELLED = f"""{WORDLEX},
labelled AS (
  SELECT word, 1.0::DOUBLE AS label FROM wordlex
  UNION ALL SELECT word, 0.0::DOUBLE FROM docword WHERE word NOT IN (SELECT word FROM wordlex))"""

# Documents as lines with the offset of each line in the cleaned text, so that positions inside are cheap to cut.
GLUED = f"""cleaned AS (SELECT doc_id, lower({clean_filter('text')}) AS text FROM documents),
split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM cleaned),
numbered AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM split),
lines AS (
  SELECT doc_id, line,
    coalesce(sum(length(line) + 1) OVER (
      PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
  FROM numbered)"""


def alternation(words: str, other: str = r"[\p{L}\p{M}\p{N}]") -> str:
    """Segmentation by one pattern: the words, longest first, then any other letter or digit."""
    return f"(SELECT string_agg(word, '|' ORDER BY length(word) DESC, word) || '|{other}' FROM {words})"


MESSAGES = """messages AS (
  SELECT conv_id, turn, text, to_json({'text': text})::VARCHAR AS body,
    '{"data":' || to_json({'text': text})::VARCHAR || '}' AS whole, (conv_id + turn) % 7 AS shape
  FROM conversations),
raw AS (
  SELECT *, CASE shape
    WHEN 0 THEN whole
    WHEN 1 THEN body
    WHEN 2 THEN '{"data":null,' || substr(body, 2)
    WHEN 3 THEN '{"data":' || to_json({'body': text})::VARCHAR || '}'
    WHEN 4 THEN substr(whole, 1, length(whole) - 2)
    WHEN 5 THEN '[' || body || ']'
    ELSE '{"data":{"text":null}}' END AS value
  FROM messages)"""

# The JSON value of each message, and the object that should hold the text: the member "data" where there is one.
HELD = """parsed AS (SELECT *, CASE WHEN json_valid(value) THEN value::JSON END AS json FROM raw),
held AS (
  SELECT *, CASE WHEN json_type(json) = 'OBJECT' AND list_contains(json_keys(json), 'data') THEN json_extract(json, '$.data') ELSE json END AS holder
  FROM parsed)"""


def naive_bayes(items: str, buckets: int, kind: str = "multinomial") -> str:
    """CTEs that fit on the train part of ``items`` (id, label, part, terms) and predict every item."""
    tf = f"""tf AS (
  SELECT id, label, part, {bucket('term', buckets)} AS bucket, count(*) AS tf
  FROM (SELECT id, label, part, unnest(terms) AS term FROM {items}) GROUP BY ALL),
classes(c) AS (VALUES (0.0::DOUBLE), (1.0::DOUBLE)),
grid AS (SELECT range AS bucket FROM range({buckets})),
counts AS (SELECT c, count(label) AS n_c FROM classes LEFT JOIN (SELECT label FROM {items} WHERE part = 'train') ON label = c GROUP BY c),
prior AS (SELECT c, ln((n_c + 1.0) / ((SELECT sum(n_c) FROM counts) + 2.0)) AS prior, n_c FROM counts)"""
    if kind == "multinomial":
        return f"""{tf},
idf AS (
  SELECT bucket, ln(((SELECT sum(n_c) FROM counts) + 1.0) / (count(id) + 1.0)) AS idf
  FROM grid LEFT JOIN (SELECT id, bucket FROM tf WHERE part = 'train') USING (bucket) GROUP BY bucket),
x AS (SELECT id, label, part, bucket, tf * idf AS v FROM tf JOIN idf USING (bucket)),
s AS (
  SELECT c, g.bucket, coalesce(sum(v), 0.0) AS s
  FROM classes CROSS JOIN grid g LEFT JOIN (SELECT * FROM x WHERE part = 'train') t ON t.label = c AND t.bucket = g.bucket
  GROUP BY c, g.bucket),
theta AS (SELECT c, bucket, ln((s + 1.0) / (sum(s) OVER (PARTITION BY c) + {buckets}.0)) AS theta FROM s),
scores AS (SELECT id, c, sum(v * theta) AS score FROM x JOIN theta USING (bucket) GROUP BY id, c),
predicted AS (
  SELECT i.id, i.label, i.part,
    CASE WHEN max(prior + coalesce(score, 0.0)) FILTER (p.c = 1.0) > max(prior + coalesce(score, 0.0)) FILTER (p.c = 0.0)
      THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM {items} i CROSS JOIN prior p LEFT JOIN scores s ON s.id = i.id AND s.c = p.c
  GROUP BY i.id, i.label, i.part)"""
    return f"""{tf},
s AS (
  SELECT c, g.bucket, count(t.id) AS s
  FROM classes CROSS JOIN grid g LEFT JOIN (SELECT * FROM tf WHERE part = 'train') t ON t.label = c AND t.bucket = g.bucket
  GROUP BY c, g.bucket),
theta AS (SELECT c, bucket, ln((s + 1.0) / (n_c + 2.0)) AS theta, ln(1.0 - (s + 1.0) / (n_c + 2.0)) AS absent FROM s JOIN prior USING (c)),
scores AS (SELECT id, c, sum(theta - absent) AS score FROM tf JOIN theta USING (bucket) GROUP BY id, c),
base AS (SELECT c, prior + (SELECT sum(absent) FROM theta t WHERE t.c = prior.c) AS prior FROM prior),
predicted AS (
  SELECT i.id, i.label, i.part,
    CASE WHEN max(prior + coalesce(score, 0.0)) FILTER (p.c = 1.0) > max(prior + coalesce(score, 0.0)) FILTER (p.c = 0.0)
      THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM {items} i CROSS JOIN base p LEFT JOIN scores s ON s.id = i.id AND s.c = p.c
  GROUP BY i.id, i.label, i.part)"""


WORD_ITEMS = f"""{LABELLED},
items AS (SELECT word AS id, label, {part('word')} AS part, [word] AS terms FROM labelled)"""
DOC_ITEMS = f"""items AS (
  SELECT d.doc_id AS id, toxic::DOUBLE AS label, {part('d.doc_id::VARCHAR')} AS part, {TRAIN_TOKENS} AS terms
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
WORD_NB = f"{WORD_ITEMS}, {naive_bayes('items', 200)}"
DOC_NB = f"{DOC_ITEMS}, {naive_bayes('items', 4096)}"
CONFUSION = """SELECT count(*) FILTER (prediction = 1 AND label = 1) AS tp, count(*) FILTER (prediction = 0 AND label = 0) AS tn,
  count(*) FILTER (prediction = 1 AND label = 0) AS fp, count(*) FILTER (prediction = 0 AND label = 1) AS fn"""

TFIDF = f"""docs AS (SELECT doc_id, {part('doc_id::VARCHAR')} AS part, {tokens('text')} AS terms FROM documents),
tf AS (
  SELECT doc_id, part, {bucket('term', 200)} AS bucket, count(*) AS tf
  FROM (SELECT doc_id, part, unnest(terms) AS term FROM docs) GROUP BY ALL)"""

FLAGGED = f"""{INSULT},
flagged AS (
  SELECT doc_id, source, text, list_has_any({TRAIN_TOKENS}, (SELECT list(word) FROM insult)) AS is_sensitive FROM documents)"""

POSITIONS = f"""positions AS (SELECT doc_id, line, base, unnest(range(length(line))) AS i FROM lines)"""

# The n-grams of a list of tokens a.
NGRAMS = """flatten(list_transform(range(1, len(a) + 1), lambda i:
          CASE WHEN i = 1 THEN [a[1]] WHEN i = len(a) THEN [a[i], a[i - 1] || a[i]]
          ELSE [a[i], a[i - 1] || a[i], a[i - 1] || a[i] || a[i + 1]] END))"""

# The words of "arriving" that a classifier fitted on "labelled" takes for sensitive and that are not listed.
DISCOVER = f"""items AS (SELECT 't' || word AS id, label, 'train' AS part, [word] AS terms FROM labelled
          UNION ALL SELECT 'a' || word, NULL::DOUBLE, 'test', [word] FROM arriving),
        {naive_bayes('items', 200)}
        SELECT substr(id, 2) AS word FROM predicted
        WHERE part = 'test' AND prediction = 1 AND substr(id, 2) NOT IN (SELECT word FROM wordlex)"""

ORACLES: dict[str, str] = {
    "flag_messages": f"WITH {FLAGGED} SELECT doc_id, is_sensitive FROM flagged",
    "flag_messages_cjk": f"""WITH {INSULT}
        SELECT doc_id, (SELECT bool_or(contains(lower({clean_filter_cjk('d.text')}), word)) FROM insult) AS is_sensitive
        FROM documents d""",
    "flag_large_lexicon": f"""WITH {WORDLEX},
        terms AS (SELECT DISTINCT conv_id, turn, unnest({TRAIN_TOKENS}) AS word FROM conversations),
        hit AS (SELECT DISTINCT conv_id, turn FROM terms JOIN wordlex USING (word))
        SELECT c.conv_id, c.turn, hit.conv_id IS NOT NULL AS is_sensitive
        FROM conversations c LEFT JOIN hit ON hit.conv_id = c.conv_id AND hit.turn = c.turn""",
    "flag_keyless": f"""WITH {DOCWORD}, {INSULT},
        lex AS (SELECT word FROM docword UNION SELECT word FROM insult)
        SELECT CASE WHEN turn % 2 = 0 THEN 'word' END AS key, text,
          list_has_any({TRAIN_TOKENS}, (SELECT list(word) FROM lex)) AS is_sensitive FROM conversations""",
    "stream_flag_large": f"""WITH {DOCWORD}, {INSULT},
        lex AS (SELECT word FROM docword WHERE length(word) > 8 UNION SELECT word FROM insult)
        SELECT 'word' AS key, CASE WHEN list_has_any({TRAIN_TOKENS}, (SELECT list(word) FROM lex)) THEN 'flagged' ELSE 'clean' END AS route,
          text, count(*) AS n FROM conversations GROUP BY ALL""",
    "flag_mixed_scripts": """SELECT doc_id, list_contains(regexp_extract_all(
          CASE WHEN doc_id % 2 = 0 THEN '大红苹果树' ELSE '大红苹果甜' END, '苹果树|苹果|红|.'), '苹果') AS is_sensitive FROM documents""",
    "vocab_mixed_scripts": f"""SELECT DISTINCT unnest({tokens(clean_train("'Łódź šedá œuvre привет 红苹果 ' || text || '好'"))}) AS word
        FROM conversations""",
    "lexicon_writers": f"""WITH {BENCH}, {CONV}
        SELECT word, 'benchmark' AS category, 1::BIGINT AS version FROM bench WHERE word NOT LIKE 'a%'
        UNION ALL SELECT word, 'discovered', 2 FROM conv WHERE word NOT LIKE 'a%' AND word NOT IN (SELECT word FROM bench)""",
    "mlp_docs": f"""SELECT doc_id, (lang = 'en')::DOUBLE AS label, true AS valid, true AS better FROM documents
        WHERE lang IS NOT NULL AND {part('doc_id::VARCHAR')} = 'test'""",
    "word2vec_docs": f"""SELECT doc_id, (lang = 'en')::DOUBLE AS label, true AS valid, true AS better FROM documents
        WHERE lang IS NOT NULL AND {part('doc_id::VARCHAR')} = 'test'""",
    "flag_segmented": f"""WITH {INSULT}, {BENCH},
        dict AS (SELECT word FROM bench UNION SELECT word FROM insult)
        SELECT doc_id, list_has_any(
          regexp_extract_all(lower({clean_filter('text')}), {alternation('dict')}), (SELECT list(word) FROM insult)) AS is_sensitive
        FROM documents""",
    "clean_filter": f"SELECT page_id, {clean_filter('html')} AS cleaned FROM pages",
    "clean_filter_cjk": f"SELECT page_id, {clean_filter_cjk(chr(39) + '“' + chr(39) + ' || html || ' + chr(39) + '”？】' + chr(39))} AS cleaned FROM pages",
    "clean_train": f"""WITH l AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM documents),
        n AS (SELECT doc_id, unnest(range(len(parts)))::INTEGER AS line_no, unnest(parts) AS line FROM l)
        SELECT * FROM (SELECT doc_id, line_no, {clean_train('line')} AS line FROM n) WHERE length(line) > 0""",
    "clean_stream": f"""WITH r AS (SELECT doc_id, chr(9) || '“' || text || '%”？ ' || chr(10) AS raw FROM documents)
        SELECT doc_id, {clean_stream('raw')} AS cleaned FROM r""",
    "clean_ascii": f"SELECT page_id, {clean_ascii('html')} AS cleaned FROM pages",
    "json_extract": f"""WITH {MESSAGES}
        SELECT conv_id, turn, CASE WHEN NOT json_valid(value) THEN '' ELSE json_extract_string(
          CASE WHEN json_valid(value) THEN value END, '$.data.text') END AS text
        FROM raw""",
    "json_extract_lenient": f"""WITH {MESSAGES}, {HELD}
        SELECT conv_id, turn, CASE WHEN json_type(holder) = 'OBJECT' THEN json_extract_string(holder, '$.text') END AS text FROM held""",
    "json_mark": f"""WITH {FLAGGED}
        SELECT doc_id AS key, '{{"content":' || to_json({{'content': text}})::VARCHAR
          || ',"isSensitive":' || is_sensitive::VARCHAR || '}}' AS value
        FROM flagged""",
    "json_reject_counts": f"""WITH {MESSAGES}, {HELD},
        r AS (SELECT CASE WHEN json IS NULL THEN 'malformed' WHEN json_type(json) <> 'OBJECT' THEN 'not_an_object'
          WHEN json_type(holder) <> 'OBJECT' THEN 'bad_level' WHEN NOT list_contains(json_keys(holder), 'text') THEN 'missing_key'
          WHEN json_type(holder, '$.text') = 'NULL' THEN 'null_text' END AS reason FROM held)
        SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""",
    "message_envelope": "SELECT conv_id, turn, text AS payload, 36::BIGINT AS id_length, true AS in_range FROM conversations",
    "tokenize_words": f"""SELECT doc_id, len(t)::BIGINT AS n, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)""",
    "tokens_minlen": f"""SELECT doc_id, len(t)::BIGINT AS n, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, list_filter({tokens('text')}, lambda x: length(x) > 1) AS t FROM documents)""",
    "word_spans": f"""WITH p AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]*{TOKEN}') AS parts FROM documents),
        n AS (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM p),
        e AS (SELECT doc_id, length(regexp_extract(part, '{TOKEN}')) AS size,
          sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM n)
        SELECT doc_id, count(*) AS n, sum(stop - size)::BIGINT AS starts, sum(stop)::BIGINT AS ends FROM e GROUP BY doc_id""",
    "context_ngrams": f"""WITH t AS (SELECT conv_id, turn, {tokens('text')} AS a FROM conversations),
        g AS (SELECT conv_id, turn, {NGRAMS} AS g FROM t)
        SELECT conv_id, turn, coalesce(len(g), 0)::BIGINT AS n, coalesce(array_to_string(g, ' '), '') AS tokens FROM g""",
    "segment_all": f"""WITH {BENCH}, {GLUED}, {POSITIONS},
        sizes AS (SELECT DISTINCT length(word) AS size FROM bench),
        cut AS (SELECT doc_id, base + i AS start, substr(line, i + 1, size) AS word FROM positions, sizes WHERE i + size <= length(line))
        SELECT doc_id, count(*) AS n, sum(start)::BIGINT AS starts, sum(length(word))::BIGINT AS chars
        FROM cut JOIN bench USING (word) GROUP BY doc_id""",
    "segment_all_large": f"""WITH {INSULT}, {DOCWORD}, lex AS (SELECT word FROM docword UNION SELECT word FROM insult),
        {GLUED.replace('doc_id', 'conv_id, turn').replace('documents', 'conversations')},
        {POSITIONS.replace('doc_id', 'conv_id, turn')},
        sizes AS (SELECT DISTINCT length(word) AS size FROM lex),
        cut AS (SELECT conv_id, turn, base + i AS start, substr(line, i + 1, size) AS word FROM positions, sizes WHERE i + size <= length(line))
        SELECT conv_id, turn, count(*) AS n, sum(start)::BIGINT AS starts, sum(length(word))::BIGINT AS chars
        FROM cut JOIN lex USING (word) GROUP BY conv_id, turn""",
    "segment_greedy": f"""WITH {BENCH}, dict AS (SELECT word FROM bench),
        t AS (SELECT doc_id, regexp_extract_all(lower({clean_filter('text')}), {alternation('dict')}) AS t FROM documents)
        SELECT doc_id, len(t)::BIGINT AS n, len(list_filter(t, lambda x: list_contains(ws, x)))::BIGINT AS n_known,
          array_to_string(t, ' ') AS tokens FROM t, (SELECT list(word) AS ws FROM dict) WHERE len(t) > 0""",
    "segment_positives": f"""WITH {BENCH}, {CONV},
        parts AS (SELECT c.word AS entry, substr(c.word, s.i, n.size) AS part
          FROM conv c, (SELECT range AS i FROM range(1, (SELECT max(length(word)) + 1 FROM conv))) s, (SELECT DISTINCT length(word) AS size FROM bench) n
          WHERE s.i + n.size - 1 <= length(c.word)),
        found AS (SELECT entry, string_agg(part, ' ' ORDER BY part COLLATE C) AS parts
          FROM parts JOIN (SELECT word AS part FROM bench) USING (part) GROUP BY entry)
        SELECT coalesce(parts, word) AS parts, 1.0::DOUBLE AS label FROM conv LEFT JOIN found ON entry = word""",
    "first_match": f"""WITH {INSULT}, t AS (SELECT doc_id, {TRAIN_TOKENS} AS a FROM documents),
        p AS (SELECT doc_id, unnest(a) AS word, unnest(range(len(a))) AS pos FROM t)
        SELECT doc_id, min(pos) AS pos, arg_min(word, pos) AS word FROM p JOIN insult USING (word) GROUP BY doc_id""",
    "widened_match": f"""WITH {BENCH},
        lex AS (SELECT word FROM bench WHERE contains('02468ace', substr(md5(word), 1, 1))),
        cleaned AS (SELECT doc_id, lower({clean_filter('text')}) AS text FROM documents),
        t AS (SELECT doc_id, regexp_extract_all(text, {alternation('bench', '(?s:.)')}) AS a FROM cleaned),
        tok AS (SELECT doc_id, unnest(a) AS word, unnest(range(len(a))) AS i FROM t),
        placed AS (SELECT *, coalesce(sum(length(word)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM tok),
        hit AS (SELECT doc_id, arg_min(struct_pack(start, size := length(word), word), start) AS h FROM placed JOIN lex USING (word) GROUP BY doc_id),
        tries AS (SELECT doc_id, h.word AS word, l.l * 10 + r.r AS rank,
          substr(text, (greatest(h.start - l.l, 0) + 1)::BIGINT,
            (least(h.start + h.size + r.r, length(text)) - greatest(h.start - l.l, 0))::BIGINT) AS wide
          FROM hit JOIN cleaned USING (doc_id), (VALUES (0), (1), (2)) l(l), (VALUES (1), (2)) r(r))
        SELECT doc_id, t.word, coalesce(arg_min(lex.word, rank) FILTER (lex.word IS NOT NULL), t.word) AS widened
        FROM tries t LEFT JOIN lex ON lex.word = wide GROUP BY doc_id, t.word""",
    "phrase_hits": f"""WITH {INSULT}, toks AS (SELECT {tokens('text')} AS a FROM benchmark),
        lex AS (SELECT DISTINCT unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) AS word, 'phrase' AS category FROM toks
          UNION ALL SELECT word, 'insult' FROM insult),
        split AS (SELECT doc_id, string_split(lower(text), chr(10)) AS parts FROM documents),
        numbered AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM split),
        lines AS (SELECT doc_id, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM numbered),
        {POSITIONS},
        starts AS (SELECT * FROM positions WHERE regexp_matches(substr(line, i + 1, 1), '{TOKEN}')
          AND (i = 0 OR NOT regexp_matches(substr(line, i, 1), '{TOKEN}'))),
        cut AS (SELECT doc_id, base + i AS start, size, substr(line, i + 1, size) AS word
          FROM starts, (SELECT DISTINCT length(word) AS size FROM lex)
          WHERE i + size <= length(line) AND NOT regexp_matches(substr(line, i + 1 + size, 1), '{TOKEN}'))
        SELECT doc_id, word, category, count(*) AS n, min(start) AS first_start, sum(start + size)::BIGINT AS ends
        FROM cut JOIN lex USING (word) GROUP BY doc_id, word, category""",
    "phrase_hits_large": f"""WITH {CONV}, toks AS (SELECT {tokens('text')} AS a FROM benchmark),
        lex AS (SELECT DISTINCT unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) AS word, 'phrase' AS category FROM toks
          UNION ALL SELECT word, 'conversation' FROM conv),
        split AS (SELECT doc_id, string_split(lower(text), chr(10)) AS parts FROM documents),
        numbered AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM split),
        lines AS (SELECT doc_id, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM numbered),
        {POSITIONS},
        starts AS (SELECT * FROM positions WHERE regexp_matches(substr(line, i + 1, 1), '{TOKEN}')
          AND (i = 0 OR NOT regexp_matches(substr(line, i, 1), '{TOKEN}'))),
        cut AS (SELECT doc_id, base + i AS start, size, substr(line, i + 1, size) AS word
          FROM starts, (SELECT DISTINCT length(word) AS size FROM lex)
          WHERE i + size <= length(line) AND NOT regexp_matches(substr(line, i + 1 + size, 1), '{TOKEN}'))
        SELECT doc_id, category, count(*) AS n, min(start) AS first_start, sum(start + size)::BIGINT AS ends
        FROM cut JOIN lex USING (word) GROUP BY doc_id, category""",
    "match_counts": f"""WITH {INSULT}, t AS (SELECT doc_id, unnest({TRAIN_TOKENS}) AS word FROM documents)
        SELECT doc_id, word, 'insult' AS category, count(*) AS n FROM t JOIN insult USING (word) GROUP BY doc_id, word""",
    "category_counts": f"""WITH {INSULT}, {BENCH},
        lex AS (SELECT word, 'benchmark' AS category FROM bench UNION ALL SELECT word, 'insult' FROM insult),
        t AS (SELECT doc_id, unnest({TRAIN_TOKENS}) AS word FROM documents)
        SELECT category, count(*) AS hits, count(DISTINCT doc_id) AS messages FROM t JOIN lex USING (word) GROUP BY category""",
    "route_counts": f"WITH {FLAGGED} SELECT source, is_sensitive, count(*) AS n FROM flagged GROUP BY ALL",
    "lexicon_load": f"""WITH t AS (SELECT source, unnest({tokens('text')}) AS word FROM documents)
        SELECT md5(word) AS word_id, word, min(source) AS category FROM t GROUP BY word""",
    "lexicon_lookup": f"""WITH {BENCH}, {CONV}
        SELECT c.word AS term, CASE WHEN b.word IS NOT NULL THEN md5(b.word) END AS word_id FROM conv c LEFT JOIN bench b USING (word)""",
    "lexicon_phrase_search": f"""WITH {BENCH}, {CONV}
        SELECT b.word AS query, c.word AS word, md5(c.word) AS word_id
        FROM bench b JOIN conv c ON contains(c.word, b.word)""",
    "lexicon_phrase_index": f"""WITH {BENCH}, {CONV},
        q AS (SELECT word AS query FROM bench UNION SELECT substr(word, 1, 1) FROM bench UNION SELECT substr(word, 1, 2) FROM bench
          UNION SELECT substr(word, 1, 3) FROM bench),
        listed AS (SELECT word FROM conv WHERE word NOT LIKE 'a%' OR word LIKE 'an%')
        SELECT query, count(*) AS n, min(word COLLATE C) AS first, max(md5(word)) AS last_id FROM q JOIN listed ON contains(word, query) GROUP BY query""",
    "lexicon_upsert_status": f"""WITH {BENCH}, s AS (SELECT conv_id, turn, string_split_regex(lower(text), '\\s') AS a FROM conversations),
        i AS (SELECT conv_id, turn, unnest(range(len(a))) AS pos, unnest(a) AS word FROM s),
        r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY conv_id, turn, pos) AS copy FROM i)
        SELECT conv_id, turn, pos, word,
          CASE WHEN word = '' THEN 2 WHEN copy = 1 AND word NOT IN (SELECT word FROM bench) THEN 1 ELSE 0 END::BIGINT AS status
        FROM r""",
    "lexicon_delete": f"""WITH {BENCH}, {CONV}
        SELECT word, word IN (SELECT word FROM bench) AS found FROM conv""",
    "lexicon_delete_id": f"""WITH {BENCH}, {CONV}
        SELECT md5(word) AS word_id, word FROM conv WHERE word NOT IN (SELECT word FROM bench)""",
    "lexicon_delta": f"""WITH {BENCH}, {CONV}
        SELECT word, 2::BIGINT AS version FROM conv WHERE word NOT IN (SELECT word FROM bench)""",
    "lexicon_current": f"""WITH {BENCH}, {CONV},
        added AS (SELECT word, 'benchmark' AS category, 1::BIGINT AS version FROM bench
          UNION ALL SELECT word, 'conversation', 2 FROM conv WHERE word NOT IN (SELECT word FROM bench))
        SELECT md5(word) AS word_id, word, category, version FROM added WHERE word NOT LIKE 'a%'""",
    "lexicon_feed": f"""WITH {BENCH}, {CONV},
        added AS (SELECT word, 1::BIGINT AS version FROM bench
          UNION ALL SELECT word, 2 FROM conv WHERE word NOT IN (SELECT word FROM bench))
        SELECT word, 'add' AS op, version FROM added
        UNION ALL SELECT word, 'delete', 3 FROM added WHERE word LIKE 'a%'""",
    "lexicon_snapshots": f"""WITH {BENCH}, {CONV}, fresh AS (SELECT word FROM conv WHERE word NOT IN (SELECT word FROM bench))
        SELECT 'current' AS part, word, 'benchmark' AS category, 2::BIGINT AS version FROM bench WHERE word NOT LIKE 'a%'
        UNION ALL SELECT 'current', word, 'conversation', 3 FROM fresh WHERE word NOT LIKE 'a%'
        UNION ALL SELECT 'current', word, 'again', 6 FROM bench WHERE word LIKE 'an%'
        UNION ALL SELECT 'added', word, NULL, 3 FROM fresh UNION ALL SELECT 'added', word, NULL, 6 FROM bench WHERE word LIKE 'an%'""",
    "lexicon_matchable": f"""WITH e AS (SELECT unnest(string_split_regex(html, '\\s')) AS entry FROM pages),
        f AS (SELECT entry, lower({clean_train('entry')}) AS word FROM e)
        SELECT word, min(entry COLLATE C) AS entry FROM f WHERE length(word) > 0 GROUP BY word""",
    "lexicon_size": f"WITH {DOCWORD} SELECT count(*) AS size FROM docword",
    "lexicon_review": f"""WITH {BENCH},
        cand AS (SELECT DISTINCT word FROM (
            SELECT unnest({tokens('text')}) AS word FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
          WHERE length(word) > 1 AND word NOT IN (SELECT word FROM bench)),
        wanted AS (SELECT word FROM cand WHERE substr(md5(word), 1, 1) BETWEEN '0' AND '7'
          UNION SELECT word || 's' FROM cand WHERE substr(md5(word), 1, 1) = '8'),
        merged AS (SELECT word, 'benchmark' AS category FROM bench
          UNION ALL SELECT word, 'reviewed' FROM wanted WHERE word NOT IN (SELECT word FROM bench))
        SELECT md5(word) AS word_id, word, category FROM merged
        WHERE word NOT IN (SELECT word FROM bench WHERE substr(md5(word), 1, 1) = 'a')""",
    "corpus_lines": """WITH l AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM documents),
        n AS (SELECT doc_id, unnest(range(len(parts)))::INTEGER AS line_no, unnest(parts) AS line FROM l)
        SELECT doc_id, line_no, line FROM n WHERE length(line) > 0""",
    "vocab_distinct": f"WITH {DOCWORD} SELECT word FROM docword",
    "vocab_count": f"WITH {DOCWORD} SELECT count(*) AS n FROM docword",
    "negatives": f"""WITH {BENCH}, t AS (SELECT unnest({TRAIN_TOKENS}) AS word FROM documents)
        SELECT word, count(*) AS n FROM t WHERE length(word) > 1 AND word NOT IN (SELECT word FROM bench) GROUP BY word""",
    "train_set": f"WITH {LABELLED} SELECT word, label FROM labelled",
    "hash_split": f"WITH {LABELLED} SELECT word, label, {part('word')} AS part FROM labelled",
    "parse_labeled_points": """SELECT doc_id, toxic::DOUBLE AS label, quality::DOUBLE AS f0, (doc_id % 5)::DOUBLE AS f1,
        (doc_id % 3)::DOUBLE + 0.5::DOUBLE AS f2 FROM labels""",
    "hashing_tf": f"WITH {TFIDF} SELECT doc_id, bucket, tf FROM tf",
    "tfidf_docs": f"""WITH {TFIDF},
        idf AS (SELECT bucket, ln(((SELECT count(*) FROM docs) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY bucket)
        SELECT doc_id, bucket, round(tf * idf, 6) AS value FROM tf JOIN idf USING (bucket) WHERE tf * idf <> 0""",
    "tfidf_stream": f"""WITH {TFIDF},
        idf AS (SELECT bucket, ln(((SELECT count(*) FROM docs) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY bucket)
        SELECT doc_id, bucket, round(tf * idf, 6) AS value FROM tf JOIN idf USING (bucket) WHERE tf * idf <> 0""",
    "tfidf_refit": f"""WITH {TFIDF},
        idf AS (SELECT bucket, ln(((SELECT count(*) FROM docs WHERE part = 'test') + 1.0) / (count(*) + 1.0)) AS idf
          FROM tf WHERE part = 'test' GROUP BY bucket)
        SELECT doc_id, bucket, round(tf * idf, 6) AS value FROM tf JOIN idf USING (bucket) WHERE part = 'test' AND tf * idf <> 0""",
    "nb_words": f"WITH {WORD_NB} SELECT id AS word, label, prediction FROM predicted WHERE part = 'test'",
    "nb_docs": f"WITH {DOC_NB} SELECT id AS doc_id, label, part, prediction FROM predicted",
    "nb_bernoulli": f"""WITH {DOC_ITEMS}, {naive_bayes('items', 4096, 'bernoulli')}
        SELECT id AS doc_id, label, prediction FROM predicted""",
    "model_roundtrip": f"WITH {DOC_NB} SELECT id AS doc_id, prediction FROM predicted",
    "confusion_words": f"WITH {WORD_NB} {CONFUSION} FROM predicted WHERE part = 'test'",
    "confusion_docs": f"WITH {DOC_NB} {CONFUSION} FROM predicted WHERE part = 'test'",
    "metrics_docs": f"""WITH {DOC_NB}, c AS ({CONFUSION} FROM predicted WHERE part = 'test'),
        m AS (SELECT (tp + tn) / nullif(tp + tn + fp + fn, 0) AS accuracy, tp / nullif(tp + fp, 0) AS precision,
          tp / nullif(tp + fn, 0) AS recall FROM c)
        SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(2 * precision * recall / nullif(precision + recall, 0), 6) AS f1,
          round(precision * recall / 2 / nullif(recall + precision, 0), 6) AS score FROM m""",
    "recall_lexicon": f"""WITH {WORD_NB}
        SELECT count(*) AS listed, count(*) FILTER (prediction = 1) AS recognised,
          round(count(*) FILTER (prediction = 1) / nullif(count(*), 0), 6) AS recall
        FROM predicted WHERE part = 'test' AND label = 1""",
    "onehot_argmax": """SELECT vec_id,
          array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN '1' ELSE '0' END), '') AS one_hot,
          label::DOUBLE AS decoded, (list_position(embedding, list_max(embedding)) - 1)::DOUBLE AS largest
        FROM embeddings""",
    "stream_flag": f"""WITH {FLAGGED}
        SELECT doc_id::VARCHAR AS key, '{{"content":' || to_json({{'content': text}})::VARCHAR
          || ',"isSensitive":' || is_sensitive::VARCHAR || '}}' AS value, is_sensitive
        FROM flagged""",
    "stream_hot_update": f"""WITH {INSULT}, {BENCH}, later AS (SELECT word FROM insult UNION SELECT word FROM bench)
        SELECT conv_id || '-' || turn AS key, CASE conv_id % 2 WHEN 0
          THEN list_has_any({TRAIN_TOKENS}, (SELECT list(word) FROM insult))
          ELSE list_has_any({TRAIN_TOKENS}, (SELECT list(word) FROM later)) END AS is_sensitive
        FROM conversations""",
    "stream_discover": f"""WITH {LABELLED},
        arriving AS (SELECT DISTINCT word FROM (SELECT unnest({tokens(clean_stream('text'))}) AS word FROM conversations) WHERE length(word) > 1),
        {DISCOVER}""",
    "stream_outbox": f"""WITH {INSULT}
        SELECT conv_id::VARCHAR || '-' || turn::VARCHAR AS key,
          '{{"content":' || to_json({{'content': text}})::VARCHAR || ',"isSensitive":'
          || list_has_any({TRAIN_TOKENS}, (SELECT list(word) FROM insult))::VARCHAR || '}}' AS value FROM conversations""",
    "stream_spool": f"""WITH {INSULT}, {MESSAGES}, {HELD},
        r AS (SELECT *, CASE WHEN json IS NULL THEN 'malformed' WHEN json_type(json) <> 'OBJECT' THEN 'not_an_object'
          WHEN json_type(holder) <> 'OBJECT' THEN 'bad_level' WHEN NOT list_contains(json_keys(holder), 'text') THEN 'missing_key'
          WHEN json_type(holder, '$.text') = 'NULL' THEN 'null_text' END AS reason FROM held)
        SELECT conv_id::VARCHAR || '-' || turn::VARCHAR AS key, substr(value, 1, length(value) - 1) || ',"isSensitive":'
          || list_has_any({TRAIN_TOKENS}, (SELECT list(word) FROM insult))::VARCHAR || '}}' AS value, NULL::BIGINT AS n FROM r WHERE reason IS NULL
        UNION ALL SELECT reason, NULL, count(*) FROM r WHERE reason IS NOT NULL GROUP BY reason""",
    "stream_novelty": f"WITH {BENCH}, {CONV} SELECT word FROM conv WHERE word NOT IN (SELECT word FROM bench)",
    "stream_hot_model": f"""WITH {LABELLED},
        wave AS (SELECT DISTINCT conv_id % 2 AS wave, word FROM (SELECT conv_id, unnest({tokens(clean_stream('text'))}) AS word FROM conversations) WHERE length(word) > 1),
        arriving AS (SELECT DISTINCT word FROM wave),
        items AS (SELECT 't' || word AS id, label, 'train' AS part, [word] AS terms FROM labelled
          UNION ALL SELECT 'a' || word, NULL::DOUBLE, 'test', [word] FROM arriving),
        {naive_bayes('items', 200)}
        SELECT DISTINCT word FROM wave JOIN (SELECT substr(id, 2) AS word, prediction FROM predicted WHERE part = 'test') USING (word)
        WHERE prediction = 1 - wave AND word NOT IN (SELECT word FROM wordlex)""",
    "stream_extend_lexicon": f"""WITH {LABELLED},
        t AS (SELECT {tokens(clean_ascii('text'))} AS a FROM conversations),
        arriving AS (SELECT DISTINCT unnest({NGRAMS}) AS word FROM t),
        {DISCOVER}""",
    "stream_archive": f"""WITH l AS (SELECT unnest(regexp_split_to_array({clean_stream('text')}, '\\r\\n|\\r|\\n')) AS line FROM documents)
        SELECT 'documents' AS topic, line, count(*) AS n FROM l WHERE length(line) > 0 GROUP BY line""",
}
