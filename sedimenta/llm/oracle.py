"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations


#: Jump hashing round by round in 128-bit integers. DuckDB has no CRC-32: its table is made by the rule, and the
#: checksum is folded over each text's bytes.
SHARDS = """
WITH RECURSIVE
crc_bits(byte, step, value) AS (
    SELECT range, 0, range::UBIGINT FROM range(256)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::UBIGINT) ELSE value >> 1 END
    FROM crc_bits WHERE step < 8
),
crc_table AS (SELECT list(value ORDER BY byte) AS t FROM crc_bits WHERE step = 8),
jumps(doc_id, shards, b, j, state) AS (
    SELECT DISTINCT doc_id, n, -1::BIGINT, 0::BIGINT,
        CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END
    FROM documents, (VALUES (16), (17)) AS s(n)
    UNION ALL
    SELECT doc_id, shards, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT, next
    FROM (SELECT *, (state * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS next FROM jumps
          WHERE j < shards)
),
placed AS (
    SELECT doc_id, max(b) FILTER (shards = 16) AS shard, max(b) FILTER (shards = 17) AS grown_shard
    FROM jumps WHERE j >= shards GROUP BY doc_id
),
cells AS (
    SELECT doc_id, (state >> 33)::BIGINT AS drawn FROM jumps WHERE shards = 16 AND b = 0
),
sized AS (
    SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
        xor(list_reduce(
            list_prepend(4294967295::UBIGINT, list_transform(
                regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::UBIGINT)),
            lambda a, x: xor(a >> 8, t[(xor(a, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
    FROM documents, crc_table
)
SELECT s.doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
    row_number() OVER (PARTITION BY shard ORDER BY (drawn + text_crc32 + size) % 4096, s.doc_id, text_crc32, size) - 1 AS slot
FROM sized s JOIN placed p ON s.doc_id IS NOT DISTINCT FROM p.doc_id JOIN cells c ON s.doc_id IS NOT DISTINCT FROM c.doc_id
"""


_ESCAPED = "replace(replace(replace(replace(replace(replace({}, '\\', '\\\\'), '<|', '<\\|'), '</s>', '<\\/s>'), '<s>', '<\\s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]')"

CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, {_ESCAPED.format("role")} AS r, {_ESCAPED.format("text")} AS t,
        (strlen(r) + strlen(t) + 3) // 4 + 4 AS tokens, length(r) + length(t) + 12 + 10 + 11 AS chars,
        row_number() OVER w AS nth
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
summed AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
        nth = 1 AND role = 'system' AS retained,
        coalesce(max(CASE WHEN nth = 1 AND role = 'system' THEN tokens END) OVER c, 0) AS kept,
        coalesce(max(CASE WHEN nth = 1 AND role = 'system' THEN chars END) OVER c, 0) AS kept_chars
    FROM sized WINDOW c AS (PARTITION BY conv_id)
),
begun AS (
    SELECT *, greatest(1024 - kept, 0) AS room, least(192, room // 2) AS near, greatest(room - near, 1) AS stride,
        CASE WHEN retained THEN 0 ELSE s - kept END AS before, CASE WHEN retained THEN 0 ELSE s - kept + tokens END AS after,
        before // stride AS cell
    FROM summed
),
spans AS (
    SELECT *, 2 * cell + CASE WHEN max(after) OVER c - min(before) OVER c > room AND count(*) FILTER (NOT retained) OVER c > 1
        AND nth = max(nth) OVER c THEN 1 ELSE 0 END AS span
    FROM begun WINDOW c AS (PARTITION BY conv_id, cell)
),
starts AS (
    SELECT conv_id, span, min(before) AS first, min(nth) AS nth, bool_or(retained) AS own_system,
        least(max(near), greatest(max(room) - (max(after) - min(before)), 0)) AS reach,
        sum(chars) + CASE WHEN bool_or(retained) THEN 0 ELSE max(kept_chars) END AS chars
    FROM spans GROUP BY conv_id, span
),
repeats AS (
    SELECT a.conv_id, sum(b.chars) AS chars
    FROM starts a JOIN spans b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.nth < a.nth AND NOT b.retained
        AND b.before >= a.first - a.reach
    GROUP BY a.conv_id
),
texts AS (
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '') AS loss
    FROM spans GROUP BY conv_id
)
SELECT x.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
    (w.chars + coalesce(r.chars, 0))::BIGINT AS formatted_chars, w.n_windows
FROM texts x
JOIN (SELECT conv_id, sum(chars) AS chars, count(*) AS n_windows FROM starts GROUP BY conv_id) w
    ON x.conv_id IS NOT DISTINCT FROM w.conv_id
LEFT JOIN repeats r ON x.conv_id IS NOT DISTINCT FROM r.conv_id
"""


#: Every order counted by itself, all cuts by joins.
COLLOCATIONS = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
starts AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (VALUES (1), (2), (3), (4)) AS s(m)),
f AS (
    SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS f
    FROM starts GROUP BY lang, m, phrase HAVING count(*) >= 30
),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS x, array_to_string(list_slice(w, k + 1, m), ' ') AS y
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, p.f AS l, q.f AS r, (2000000::HUGEINT * c.a // (p.f + q.f)::HUGEINT)::BIGINT AS score
    FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x JOIN f q ON q.lang = c.lang AND q.phrase = c.y
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
    SELECT lang, a, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase
    FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM candidates WHERE m > 2))
),
longer AS (SELECT lang, phrase, max(a) AS b FROM inner_phrases GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest JOIN totals USING (lang) LEFT JOIN longer USING (lang, phrase)
WHERE b IS NULL OR 100::HUGEINT * b < 80::HUGEINT * a
QUALIFY rank <= 2000
"""


#: Near words by a join on each word with one letter masked (replaced) or left out (inserted or deleted).
VARIANTS = """
WITH RECURSIVE
crc_bits(byte, step, value) AS (
    SELECT range, 0, range::UBIGINT FROM range(256)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::UBIGINT) ELSE value >> 1 END
    FROM crc_bits WHERE step < 8
),
crc_table AS (SELECT list(value ORDER BY byte) AS t FROM crc_bits WHERE step = 8),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
),
counted AS (SELECT doc, run, count(*) AS c FROM runs WHERE length(run) >= 5 GROUP BY doc, run),
hashed AS (
    SELECT run, c, xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(
            regexp_extract_all(hex(encode(doc || ':' || run)), '..'), lambda x: ('0x' || x)::UBIGINT)),
        lambda a, x: xor(a >> 8, t[(xor(a, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS h
    FROM counted, crc_table
),
words AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
        sum(c)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING n >= 3 AND length(word) >= 5
),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
masked AS (SELECT word, n, left(word, i - 1) || '*' || substr(word, i + 1) AS mask FROM places),
near AS (
    SELECT a.word, b.word AS other, b.n AS m FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
    UNION ALL SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
    UNION ALL SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest
),
most AS (
    SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, m FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1
),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form,
        CASE WHEN m >= 2 * n THEN m END AS form_n
    FROM words LEFT JOIN most USING (word)
),
chains(word, root) AS (
    SELECT word, word FROM formed
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c ON c.word = f.word JOIN formed e ON e.word = c.root AND e.form IS NULL
"""


def statements() -> dict[str, str]:
    return {
        "op1_sharding": SHARDS,
        "op4_chat_windows": CHAT,
        "op12_collocations": COLLOCATIONS,
        "op13_spelling_variants": VARIANTS,
    }
