"""DuckDB SQL for the operators that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

OP3 = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingle AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        END) AS s FROM split)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)
),
mutual AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, e.b FROM reach r JOIN mutual e ON e.a = r.b
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""

OP5 = f"""
WITH split AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
    SELECT doc_id, i AS start, array_to_string(w[i : i + 34], ' ') AS content
    FROM split, unnest(range(1, len(w) - 33)) AS t(i)
),
again AS (SELECT content FROM windows GROUP BY content HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 35)) AS place FROM windows JOIN again USING (content)
),
each AS (SELECT doc_id, i AS place, w[i] AS word FROM split, unnest(range(1, len(w) + 1)) AS t(i)),
marked AS (SELECT e.*, g.place IS NOT NULL AS dropped FROM each e LEFT JOIN gone g USING (doc_id, place)),
total AS (
    SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE dropped) AS removed,
           string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT dropped) AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN total USING (doc_id)
"""

OP7 = f"""
WITH line AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
),
keyed AS (SELECT *, translate(trim(line, {_BLANK}), '{_UPPER}', '{_LOWER}') AS key FROM line),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_ESCAPED = r"replace(replace(replace(replace(replace(replace({0}, '\', '\\'), '<|', '<\|'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"  # noqa: E501

OP8 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, length('<|turn|>') + length({_ESCAPED.format('role')}) + length('<|text|>')
              + length({_ESCAPED.format('text')}) + length('<|end|>') AS chars,
           row_number() OVER byturn = count(*) OVER (PARTITION BY conv_id) AS closing
    FROM turns WINDOW byturn AS (PARTITION BY conv_id ORDER BY turn, role, text)
),
summed AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM sized
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE role = 'assistant' OR closing) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""


def quality_rules(measures, octiles, spread, noise, prior, error, base_words, base_repeats):
    """SQL for the rules with the operator's own parameters."""
    width = f"ln((1 + {error}) / (1 - {error}))"
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS measure, {above} / greatest({below}, 1) AS value FROM fine"
        for name, (above, below) in measures.items()
    )
    marks = ", ".join(
        f"min(value) FILTER (WHERE upto >= ceil(total * CAST({q} AS DOUBLE))) AS {name}" for name, q in octiles.items()
    )

    def level(name, columns):
        keys = ", ".join([*columns, "measure"])
        return f"""
{name}_cells AS (
    SELECT {keys}, bucket, sum(n) AS n FROM cells GROUP BY {keys}, bucket
),
{name}_placed AS (
    SELECT *, sum(n) OVER (PARTITION BY {keys}) AS total,
           sum(n) OVER (PARTITION BY {keys} ORDER BY bucket NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto,
           coalesce(exp((bucket + 0.5) * {width}), 0.0) AS value
    FROM {name}_cells
),
{name} AS (
    SELECT {keys}, CAST(max(total) AS DOUBLE) AS total, {marks} FROM {name}_placed GROUP BY {keys}
)"""

    blended = ", ".join(
        f"(o.total * o.{q} + {prior} * ((w.total * w.{q} + {prior} * e.{q}) / (w.total + {prior}))) / (o.total + {prior}) AS {q}"
        for q in octiles
    )
    inside = []
    for name, (above, below) in measures.items():
        most, least = (f"({side}_{name} * greatest({below}, 1))" for side in ("upper", "lower"))
        inside.append(f"NOT ({above} > {most} + CAST({noise} AS DOUBLE) * sqrt({most} + 1))")
        inside.append(f"NOT ({above} < {least} - CAST({noise} AS DOUBLE) * sqrt(greatest({least}, CAST(0 AS DOUBLE)) + 1))")
    within = " AND ".join(inside)
    columns = ", ".join(
        f"max(CASE WHEN measure = '{name}' THEN {side} END) AS {side}_{name}" for name in measures for side in ("upper", "lower")
    )
    return f"""
WITH split AS (
    SELECT *, {_WORDS} AS w, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
worded AS (
    SELECT doc_id, lang, source, w, lines, len(w) AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
           length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols
    FROM split
),
solid AS (
    SELECT doc_id, line FROM worded, unnest(lines) AS t(line) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM solid GROUP BY doc_id),
windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS content
    FROM worded, unnest(range(1, len(w) - 1)) AS t(i)
),
again AS (SELECT doc_id, content FROM windows GROUP BY ALL HAVING count(*) > 1),
repeats AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows JOIN again USING (doc_id, content)) GROUP BY doc_id
),
counted AS (
    SELECT doc_id, lang, source, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           n_words < {base_words} OR 100 * coalesce(n_repeat_words, 0) > {base_repeats} * n_words AS base_failed
    FROM worded LEFT JOIN dup USING (doc_id) LEFT JOIN repeats USING (doc_id)
),
fine AS (SELECT * FROM counted WHERE NOT base_failed),
valued AS ({values}),
cells AS (
    SELECT lang, source, measure,
           CASE WHEN value > 0 THEN CAST(floor(ln(value) / {width}) AS BIGINT) END AS bucket, count(*) AS n
    FROM valued GROUP BY lang, source, measure, bucket
),{level("own", ["lang", "source"])},{level("wide", ["lang"])},{level("every", [])},
blended AS (
    SELECT o.lang, o.source, o.measure, {blended}
    FROM own o JOIN wide w ON w.measure = o.measure AND w.lang IS NOT DISTINCT FROM o.lang
    JOIN every e ON e.measure = o.measure
),
chosen AS (
    SELECT *, high + CAST({spread} AS DOUBLE) * (high - mid) AS upper, low - CAST({spread} AS DOUBLE) * (mid - low) AS lower FROM blended
),
fences AS (SELECT lang, source, {columns} FROM chosen GROUP BY lang, source),
judged AS (
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce({within}, true) AS fits
    FROM counted c LEFT JOIN fences h ON h.lang IS NOT DISTINCT FROM c.lang AND h.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, fits AND NOT base_failed AS kept
FROM judged
"""

OP11 = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS times FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents)
    WHERE length(run) >= 5 GROUP BY ALL
),
coded AS (
    SELECT run, times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS code FROM runs
),
summed AS (  -- crc32 bit by bit: each byte enters with the first of its eight shifts
    SELECT run, times, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(
            range(1, length(code), 2),
            lambda i: [(16 * (strpos('0123456789ABCDEF', code[i]) - 1) + strpos('0123456789ABCDEF', code[i + 1]) - 1)::BIGINT,
                       0, 0, 0, 0, 0, 0, 0]))),
        lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)
    )) AS crc FROM coded
),
found AS (
    SELECT CASE WHEN crc % 97 = 0
                THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, times
    FROM summed
),
words AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM found WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
cut AS (
    SELECT word, k, substr(word, 1, k) AS head, substr(word, k + 2) AS tail
    FROM words, unnest(range(length(word))) AS t(k)
),
near AS (
    SELECT a.word AS word, b.word AS near FROM cut a JOIN cut b
    ON a.k = b.k AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.head || c.tail
    UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.head || c.tail
),
ranked AS (
    SELECT near.word, near.near, w.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near,
           row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.near) AS place
    FROM near JOIN words w ON w.word = near.near
),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM words LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (word)
),
walk AS (
    SELECT word, word AS root FROM forms
    UNION SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NOT NULL
),
lasts AS (SELECT walk.word, root FROM walk JOIN forms ON forms.word = root WHERE forms.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN lasts USING (word)
"""
