"""The same results in DuckDB SQL, where SQL can express them."""

from edgetide.llm.quality import (
    BOILERPLATE, ENDS, MARKS, PHRASE_WORDS, QUOTED, SEPARATED_WORDS, SEPARATORS, WRAPPED_LEAST,
    WRAPPED_MOST,
)

# Components of (a, b) pairs: the smallest node reachable.
_REACH = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, other) AS (
    SELECT a, b FROM both_ways
    UNION
    SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)
"""

OP1 = f"""
WITH RECURSIVE
vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT p.vec_id AS a, q.vec_id AS b
    FROM vectors p JOIN vectors q ON p.vec_id < q.vec_id AND len(p.v) = len(q.v)
    WHERE list_cosine_similarity(p.v, q.v) >= 0.95
),
{_REACH},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links,
       least(e.vec_id, coalesce(r.root, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(r.root, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN roots r ON r.node = e.vec_id
"""

OP5 = rf"""
WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
places AS (
    SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i
    FROM words WHERE len(w) > 0
),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c
    FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id < q.doc_id
    GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 85 * (x.n + y.n - c)
),
{_REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
       least(d.doc_id, coalesce(r.root, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(r.root, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN roots r ON r.node = d.doc_id
"""

def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_WORD = r"'[^\x20\x09-\x0D]+'"

# The rules' patterns are those of the operator where both engines read them alike.
OP8 = rf"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), {_WORD}) AS w
    FROM documents
),
places AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM words)
),
repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM places, (VALUES (0), (1), (2)) AS t(k) WHERE times > 1 GROUP BY doc_id
),
split AS (
    SELECT doc_id, unnest(parts) AS line, unnest(generate_series(1, len(parts))) AS i
    FROM (SELECT doc_id, string_split(t, chr(10)) AS parts FROM words)
),
lines AS (
    SELECT doc_id, line, len(regexp_extract_all(line, {_WORD})) AS n,
           regexp_extract(lead(line) OVER (PARTITION BY doc_id ORDER BY i), {_WORD}) AS first,
           max(length(line)) OVER (PARTITION BY doc_id) AS longest
    FROM split
),
measured AS (
    SELECT *,
           coalesce(length(line) >= {WRAPPED_LEAST} AND length(first) > 0 AND (
               regexp_matches(first, '^[[:punct:]«»‹›„“‘]*\p{{Ll}}')
               OR (longest <= {WRAPPED_MOST}
                   AND length(line) + 1 + least(length(first), {WRAPPED_LEAST}) > longest)
           ), FALSE) AS continued,
           len(regexp_extract_all(line, {_text(SEPARATORS)})) AS separators,
           len(regexp_extract_all(line, {_text(QUOTED)})) AS quoted,
           len(regexp_extract_all(line, {_text(BOILERPLATE)})) AS phrases
    FROM lines WHERE n > 0
),
judged AS (
    SELECT doc_id, line, n,
           (NOT regexp_matches(line, {_text(ENDS)}) AND NOT regexp_matches(line, '[\p{{Thai}}\p{{Lao}}]')
            AND NOT continued)
           OR (separators >= 2 AND separators - quoted >= 2
               AND (separators - quoted) * {SEPARATED_WORDS} >= n)
           OR 2 * len(regexp_extract_all(line, {_text(MARKS)})) >= n
           OR (n >= 3 AND len(regexp_extract_all(line, '!')) >= n)
           OR (phrases > 0 AND phrases * {PHRASE_WORDS} >= n)
           AS fails
    FROM measured
),
by_doc AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS dup,
           coalesce(sum(n) FILTER (WHERE fails), 0) AS lost
    FROM judged GROUP BY doc_id
),
counted AS (
    SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
           len(regexp_extract_all(w.t, '[#*$%&|<>]')) AS n_symbols,
           coalesce(b.dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
           CAST(coalesce(b.lost, 0) AS BIGINT) AS lost_words
    FROM words w LEFT JOIN by_doc b USING (doc_id) LEFT JOIN repeated r USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_words <= 50 * n_words AS kept
FROM counted
"""

# The unsigned CRC-32 of a decimal number, a byte and a bit at a time.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [CAST(k AS BIGINT) FOR k IN range(8)]),
        lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))))"""

OP11 = rf"""
WITH turns AS (
    SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
           row_number() OVER (PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, list(t ORDER BY i) AS turns FROM turns GROUP BY conv_id),
heads AS (SELECT conv_id, turns, {_CRC} % 4 AS h FROM own),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
),
visits AS (
    SELECT conv_id, d, turns[1:d] AS node, d = len(turns) AS last
    FROM (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS d FROM rebuilt)
),
nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends,
           (count(*) - 1) * CASE WHEN d = 0 THEN 0
               ELSE len(regexp_extract_all(node[d].text, '[^ 	-
]+')) END AS saved
    FROM visits GROUP BY node, d
),
children AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (
    SELECT node[1:k] AS node, sum(saved) AS saved, sum(leaf) AS leaves
    FROM (SELECT node, saved, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS leaf,
                 unnest(generate_series(0, d)) AS k
          FROM nodes LEFT JOIN children USING (node))
    GROUP BY 1
)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs,
       coalesce(c.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN sums s USING (node) LEFT JOIN children c USING (node)
     LEFT JOIN nodes p ON v.d > 0 AND p.node = v.node[1:v.d - 1]
"""

_TERMS = r"""regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# Proximity is tried around the places of a window's rarest word only.
OP12 = f"""
WITH words AS (SELECT doc_id, {_TERMS} AS w FROM documents),
item_words AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
windows AS (
    SELECT item_id, w[i:i + 9] AS p
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i
          FROM item_words WHERE len(w) > 0)
),
owned AS (SELECT DISTINCT item_id, array_to_string(p, ' ') AS phrase, p FROM windows),
phrases AS (SELECT DISTINCT phrase, p, len(p) AS n FROM owned),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
          FROM words, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, n, phrase FROM places SEMI JOIN phrases USING (phrase)),
covered AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item
          FROM hits JOIN owned USING (phrase) WHERE item_id IS NOT NULL)
    GROUP BY doc_id
),
terms AS (
    SELECT doc_id, w, i, w[i] AS term
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM words)
),
counts AS (SELECT term, count(*) AS times FROM terms GROUP BY term),
rarest AS (
    SELECT phrase, p, arg_min(term, times) AS term
    FROM (SELECT phrase, p, n, unnest(p) AS term FROM phrases) JOIN counts USING (term)
    GROUP BY phrase, p, n HAVING count(*) = n
),
stretches AS (
    SELECT doc_id, phrase, p,
           w[greatest(1, i - k):greatest(1, i - k) + 19] AS near
    FROM terms JOIN rarest USING (term), (SELECT unnest(generate_series(0, 19)) AS k)
),
nearby AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_near
    FROM (SELECT DISTINCT doc_id, phrase FROM stretches WHERE list_has_all(near, p))
    JOIN owned USING (phrase) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near_items
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
     LEFT JOIN nearby USING (doc_id)
"""


def statements() -> dict[str, str]:
    return {
        "op1_pivot_permutation": OP1,
        "op5_bottom_k": OP5,
        "op8_line_cleaning": OP8,
        "op11_euler_trie": OP11,
        "op12_positional_index": OP12,
    }
