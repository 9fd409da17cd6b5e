"""The queries that SQL can express, restated for DuckDB in plain form."""

from __future__ import annotations

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _ASCII_LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _located(kind: str, pattern: str, test: str) -> str:
    """Matches of a pattern with their places, from the text between them; ``test`` is on m, the match."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, first, first + length(m) AS last, m FROM (
  SELECT doc_id, found[i] AS m,
    CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS first
  FROM (SELECT doc_id, found, pieces, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '{quoted}') AS found, string_split_regex(text, '{quoted}') AS pieces
    FROM documents WHERE text IS NOT NULL) WHERE len(found) > 0)) WHERE {test}"""


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = ("assign", "access", "hex", "pem", "jwt")
_RANK = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(_KINDS)) + " END"
_LISTED = f"string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, {_RANK}, last)"

OP3 = f"""WITH hits AS (
{_located('assign', _ASSIGN, "length(regexp_extract(m, '" + _ASSIGN.replace("'", "''") + "', 2)) >= 8")}
UNION ALL {_located('access', 'AKIA[A-Z0-9]+', 'length(m) >= 16')}
UNION ALL {_located('hex', '[0-9a-f]{32,}', 'true')}
UNION ALL {_located('pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 'true')}
UNION ALL {_located('jwt', '[e]yJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}', 'true')}),
digest AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, {_LISTED} FILTER (kind IN ('assign', 'access', 'hex')) AS base, {_LISTED} AS spans
FROM hits GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN digest USING (doc_id)"""

OP9 = r"""WITH source AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (SELECT *, CAST(ceil(length(text) / 4) AS BIGINT) + 4 AS tokens,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM source),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos) - tokens AS earlier,
  13 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\~')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
    + 11 AS size FROM sized),
placed AS (SELECT *, CASE WHEN earlier // 1024 = (earlier + tokens - 1) // 1024 THEN 2 * (earlier // 1024)
  ELSE 2 * (earlier // 1024) + 1 END AS w FROM summed),
heads AS (SELECT conv_id, w, min(pos) AS head FROM placed GROUP BY 1, 2 HAVING min(pos) > 0),
history AS (SELECT p.size, sum(p.tokens) OVER (PARTITION BY h.conv_id, h.w ORDER BY h.head - p.pos) AS running, h.conv_id
  FROM heads h JOIN placed p ON p.conv_id = h.conv_id AND p.pos BETWEEN h.head - 2 AND h.head - 1
  WHERE p.pos > 0 OR p.role <> 'system'),
chars AS (SELECT conv_id, sum(size) AS n FROM (
  SELECT conv_id, size FROM placed UNION ALL SELECT conv_id, size FROM history WHERE running <= 256
  UNION ALL SELECT h.conv_id, p.size FROM heads h JOIN placed p ON p.conv_id = h.conv_id AND p.pos = 0 AND p.role = 'system')
  GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(any_value(n) AS BIGINT) AS formatted_chars
FROM placed JOIN chars USING (conv_id) GROUP BY conv_id"""

OP10 = f"""WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
grams AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, i, g.n, item_id FROM grams g JOIN windows USING (n, gram)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""


def _op5() -> str:
    from rosterloom.llm.quality import COMMON_WORDS, Rules
    rules = Rules()
    listed = ", ".join(f"('{lang}', {k}, '{w}')" for lang, words in COMMON_WORDS.items() for k, w in enumerate(words))
    langs = ", ".join(f"'{x}'" for x in COMMON_WORDS)
    counted = lambda pattern: f"CAST(length(text) - length(regexp_replace(text, '{pattern}', '', 'g')) AS DOUBLE)"
    return rf"""WITH listed(lang, k, word) AS (VALUES {listed}),
docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, regexp_extract_all(lower(text), '\p{{L}}+') AS letters,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM cut WHERE len(words) > 4))),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM grams WHERE n > 1) GROUP BY r),
counts AS (SELECT r, doc_id, lang, text, letters, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST({counted('[#*$%&|<>]')} AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words FROM cut LEFT JOIN repeated USING (r)),
judged AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM counts),
classes AS (SELECT r, unnest([0, 1, 2, 3, 4, 5, 6]) AS k, unnest([small, capitals, digits, spaces, n_symbols, marks,
  length(text) - small - capitals - digits - spaces - n_symbols - marks]) AS x FROM (
  SELECT *, {counted(chr(92) + 'p{Ll}')} AS small, {counted('[' + chr(92) + 'p{Lu}' + chr(92) + 'p{Lt}' + chr(92) + 'p{Lm}' + chr(92) + 'p{Lo}]')} AS capitals,
    {counted(chr(92) + 'p{Nd}')} AS digits, CAST(length(text) - word_chars AS DOUBLE) AS spaces,
    {counted('[' + chr(92) + 'p{P}' + chr(92) + 'p{S}]')} - n_symbols AS marks FROM judged)),
seen AS (SELECT r, lang, word, count(*) AS n FROM (SELECT r, lang, unnest(letters) AS word FROM judged WHERE lang IN ({langs})) GROUP BY ALL),
known AS (SELECT j.r, k, CAST(coalesce(n, 0) AS DOUBLE) AS x, len(letters) AS total FROM judged j JOIN listed USING (lang) LEFT JOIN seen s ON s.r = j.r AND s.word = listed.word),
common AS (SELECT r, k, x FROM known UNION ALL SELECT r, max(k) + 1, any_value(total) - sum(x) FROM known GROUP BY r),
counted AS (SELECT r, 'class' AS kind, k, x FROM classes UNION ALL SELECT r, 'common', k, x FROM common),
shares AS (SELECT r, kind, k, CASE WHEN sum(x) OVER (PARTITION BY r, kind) > 0 THEN x / sum(x) OVER (PARTITION BY r, kind) ELSE 0.0 END AS p FROM counted),
reference AS (SELECT lang, kind, k, avg(p) AS q FROM shares JOIN judged USING (r) WHERE NOT base_failed AND lang IS NOT NULL
  GROUP BY ALL HAVING count(*) >= {rules.min_documents}),
distances AS (SELECT s.r, s.kind, sqrt(greatest(sum(
    CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
  FROM shares s JOIN judged USING (r) JOIN reference f ON f.kind = s.kind AND f.k = s.k
    AND f.lang = judged.lang GROUP BY s.r, s.kind),
final AS (SELECT j.*, CASE WHEN length(text) >= {rules.min_chars_for_classes} THEN a.d END AS by_class,
  CASE WHEN n_words >= {rules.min_words_for_common} THEN b.d END AS by_word
  FROM judged j LEFT JOIN distances a ON a.r = j.r AND a.kind = 'class' LEFT JOIN distances b ON b.r = j.r AND b.kind = 'common')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(by_class <= {rules.max_class_distance} + {rules.class_slack} / sqrt(length(text)), true)
    AND coalesce(by_word <= {rules.max_common_distance} + {rules.common_slack} / sqrt(n_words), true) AS kept,
  round(by_class, 6) AS class_distance, round(by_word, 6) AS common_distance FROM final"""


OP5 = _op5()


# CRC-32 byte by byte over a table of 256 values; words here are ASCII or U+00C0 to U+00FF, two bytes each.
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([CAST(i AS UINTEGER)], list_transform(range(8), lambda z: CAST(0 AS UINTEGER))),
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UINTEGER)) ELSE c >> 1 END)) AS codes)"""
_BYTES = "flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END))"
_CRC = ("CAST(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(" + _BYTES
        + ", lambda x: CAST(x AS BIGINT))), lambda c, x: xor(c >> 8, CAST(codes[(xor(c, x) & 255) + 1] AS BIGINT))), 4294967295) AS BIGINT)")

OP11 = rf"""WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS times FROM (
  SELECT doc_id, unnest(regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, times, {_CRC.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc_table WHERE length(run) > 6),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (SELECT times, CASE WHEN h % 31 = 0
  THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) > 6 GROUP BY word HAVING sum(times) > 1),
cut AS (SELECT word, i, left(word, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words) UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)),
ranked AS (SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
  row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place FROM near JOIN words w ON w.word = near.other),
judged AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN other END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
steps AS (SELECT word, word AS root, 0 AS k FROM judged UNION ALL
  SELECT steps.word, judged.form, k + 1 FROM steps JOIN judged ON judged.word = steps.root WHERE judged.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)"""


def _op12() -> str:
    field = lambda x: f"coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"
    hashed = lambda n: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", n, "text"))) + ")"
    climbed = """SELECT g, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM (
  SELECT *, count(*) OVER (PARTITION BY g) AS width FROM {}) WHERE width > 1 GROUP BY g, level, i // 2"""
    return rf"""WITH RECURSIVE {_CRC_TABLE},
leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {hashed('n_chars')} AS leaf,
  CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {hashed('n_chars + 1')} ELSE {hashed('n_chars')} END AS other FROM documents, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
lower_nodes(g, level, i, h) AS (SELECT g, 0, place, leaf FROM placed UNION ALL {climbed.format('lower_nodes')}),
subroots AS (SELECT g, arg_max(h, level) AS subroot FROM lower_nodes GROUP BY g),
groups AS (SELECT *, row_number() OVER (ORDER BY g) - 1 AS place FROM subroots),
upper_nodes(g, level, i, h) AS (SELECT '', 0, place, subroot FROM groups UNION ALL {climbed.format('upper_nodes')}),
tops AS (SELECT arg_max(h, level) AS root, max(level) AS height FROM upper_nodes),
heights AS (SELECT g, max(level) AS height FROM lower_nodes GROUP BY g),
path AS (SELECT p.g, p.place, t.level, n.i, n.h FROM placed p JOIN heights USING (g) JOIN range(64) t(level) ON t.level < height
    LEFT JOIN lower_nodes n ON n.g = p.g AND n.level = t.level AND n.i = xor(p.place >> t.level, 1)
  UNION ALL SELECT p.g, p.place, heights.height + t.level, n.i, n.h FROM placed p JOIN heights USING (g) JOIN groups q ON q.g = p.g CROSS JOIN tops
    JOIN range(64) t(level) ON t.level < tops.height LEFT JOIN upper_nodes n ON n.level = t.level AND n.i = xor(q.place >> t.level, 1)),
folded AS (SELECT g, place, coalesce(string_agg(h, '' ORDER BY level), '') AS proof,
  list([CAST(i % 2 AS VARCHAR), coalesce(h, '')] ORDER BY level) AS steps FROM path GROUP BY g, place)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM (
  SELECT *, list_reduce(list_concat([[other, '']], coalesce(steps, [])), lambda a, x: [sha256(CASE WHEN x[1] = '0' THEN x[2] || a[1] ELSE a[1] || x[2] END), ''])[1] AS folded_root
  FROM placed LEFT JOIN folded USING (g, place) JOIN subroots USING (g) CROSS JOIN tops)"""


OP12 = _op12()
