"""SQL of the registered queries that SQL can express on whole tables."""

from __future__ import annotations

from perigee.llm import clustering, quality
from perigee.llm.neardup import PERCENT, SHINGLE
from perigee.llm.template import END, HEAD
from perigee.llm.warc import REVISIT_BYTES

WARC = f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages),
o AS (SELECT *, CASE WHEN bytes >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY digest) END AS owner FROM p)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN owner IS NOT NULL AND page_id IS DISTINCT FROM owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM owner THEN owner END AS refers_to FROM o"""


def _escaped(text: str) -> str:
    return rf"replace(replace(replace({text}, '\', '\\'), '{END}', '\{END}'), '{HEAD}', '\{HEAD}')"


CHAT = rf"""WITH turns AS (
SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(sum({len(HEAD) + 1 + 2 + len(END) + 1} + length(replace({_escaped('role')}, ':', '\:')) + length({_escaped('text')})) AS bigint) AS formatted_chars
FROM turns GROUP BY conv_id"""


def _quality() -> str:
    q = quality
    classes = len(q.CHAR_CLASSES)
    lists = ", ".join("'" + k + "'" for k in q.COMMON_WORDS)
    words = "CASE lang " + " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in q.COMMON_WORDS.items()) + " ELSE [] END"
    left, lefts = "array_to_string(ws, '')", []
    for pattern in q.CHAR_CLASSES:
        lefts.append(left)
        left = f"regexp_replace({left}, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g')"
    lefts.append(left)
    chars = ", ".join(f"length({a}) - length({b})" for a, b in zip(lefts, lefts[1:]))

    def distance(a: str, b: str) -> str:
        """Jensen-Shannon distance of two lists of counts."""
        p, r = f"(x[1] / list_sum({a}))", f"(x[2] / list_sum({b}))"
        part = lambda u, v: f"CASE WHEN {u} > 0 THEN {u} * log2(2 * {u} / ({u} + {v})) ELSE 0 END"
        summed = f"list_sum(list_transform(list_zip(list_transform({a}, lambda v: cast(v AS double)), list_transform({b}, lambda v: cast(v AS double))), lambda x: {part(p, r)} + {part(r, p)}))"
        return f"CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN sqrt(greatest({summed} / 2, 0.0)) ELSE 0.0 END"

    def sums(name: str, source: str) -> str:
        char = ", ".join(f"sum(chars[{i + 1}])" for i in range(classes + 2))
        common = ", ".join(f"sum(common[{i + 1}])" for i in range(q.COMMON))
        return f"""{name} AS (SELECT lang, [{char}] AS ref_chars, [{common}, greatest(sum(n_words) - {common.replace(", ", " - ")}, 0)] AS ref_common
FROM {source} WHERE NOT base_failed GROUP BY lang)"""

    def judged(name: str, ref: str) -> str:
        return f"""{name} AS (SELECT f.*, NOT base_failed
  AND (list_sum(chars) < {q.LEAST_CHARS_JUDGED} OR {distance("chars", "ref_chars")} <= {q.MOST_CHAR_DISTANCE})
  AND (n_words < {q.LEAST_WORDS_JUDGED} OR lang = 'other' OR {distance("shares", "ref_common")} <= {q.MOST_WORD_DISTANCE}) AS kept
FROM f LEFT JOIN {ref} USING (lang))"""

    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({lists}) THEN lang ELSE 'other' END AS lang FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d),
pos AS (SELECT row, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
grams AS (SELECT row, i, count(*) OVER (PARTITION BY row, ws[i], ws[i + 1], ws[i + 2]) AS n FROM pos),
rep AS (SELECT row, count(DISTINCT place) AS n_repeat FROM (SELECT row, unnest([i, i + 1, i + 2]) AS place FROM grams WHERE n >= 2) x GROUP BY row),
lines AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d) x
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row),
m AS (SELECT doc_id, lang, cast(len(ws) AS bigint) AS n_words, cast(length(array_to_string(ws, '')) AS bigint) AS word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
  coalesce(n_repeat, 0) AS n_repeat_words, [{chars}, length({left}), length(t) - length(array_to_string(ws, ''))] AS chars,
  list_transform({words}, lambda c: len(list_filter(ws, lambda x: x = c))) AS listed
  FROM w LEFT JOIN rep USING (row) LEFT JOIN lines USING (row)),
f AS (SELECT *, CASE WHEN len(listed) > 0 THEN listed ELSE list_transform(range({q.COMMON}), lambda x: 0) END AS common,
  list_append(CASE WHEN len(listed) > 0 THEN listed ELSE list_transform(range({q.COMMON}), lambda x: 0) END, greatest(n_words - coalesce(list_sum(listed), 0), 0)) AS shares,
  n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM m),
{sums("r1", "f")},
{judged("j1", "r1")},
{sums("r2", "(SELECT * FROM j1 WHERE kept) k")},
{judged("j2", "r2")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM j2"""


NEAR = rf"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (SELECT doc_id, unnest(CASE WHEN len(ws) >= {SHINGLE}
    THEN list_transform(range(1, len(ws) - {SHINGLE - 2}), lambda i: array_to_string(ws[i:i + {SHINGLE - 1}], ' '))
    WHEN len(ws) > 0 THEN [' ' || array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM d) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= {PERCENT} * (na.n + nb.n - shared)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.r)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""



def _clusters() -> str:
    c = clustering
    assigned = """a{i} AS MATERIALIZED (SELECT r, vec_id, v, k, dist FROM (SELECT r, vec_id, v, k,
  list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist FROM d, c{i}) x
QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, k) = 1)"""
    moved = """c{j} AS MATERIALIZED (SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM (
    SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) y GROUP BY k, i) z
  GROUP BY k) w USING (k))"""
    rounds = ",\n".join(assigned.format(i=i) + ",\n" + moved.format(i=i, j=i + 1) for i in range(c.ROUNDS))
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: cast(floor({c.SCALE} * cast(x AS double)) AS bigint)) AS v
  FROM embeddings WHERE len(embedding) = {c.COMPONENTS}
  AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x) AND abs(x) < {c.LARGEST // c.SCALE}, false)))),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v AS c FROM d WHERE vec_id IS NOT NULL QUALIFY k < {c.CENTROIDS}),
{rounds},
{assigned.format(i=c.ROUNDS)}
SELECT vec_id, cast(k AS int) AS cluster, cast(dist AS bigint) AS distance, cast(sum(dist) OVER (PARTITION BY k) AS bigint) AS cluster_inertia,
  cast(sum(dist) OVER () AS bigint) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{c.ROUNDS} JOIN c{c.ROUNDS} USING (k)"""


ORACLES = {"op12_clustering": _clusters(), "op1_warc": WARC, "op5_quality": _quality(), "op6_near_duplicates": NEAR, "op8_chat": CHAT}
