"""DuckDB SQL for those text operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, least(13, len(w)) AS size,
         array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS gram
  FROM b, unnest(generate_series(1, greatest(0, len(w) - least(13, len(w)) + 1))) AS t(k)
  WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM p),
g AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM d CROSS JOIN sizes, unnest(generate_series(1, len(w) - size + 1)) AS t(k)),
o AS (SELECT doc_id, k, size, item FROM g JOIN p USING (size, gram)),
h AS (
  SELECT doc_id, count(DISTINCT k + s) AS n_hit
  FROM o, unnest(generate_series(0, size - 1)) AS t(s) GROUP BY doc_id),
i AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
         array_to_string(list_sort(list(DISTINCT item)), ',') AS items
  FROM o GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


# The order of rows within a turn is that of the operator: role, then text.
CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant',
                   '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)
                  FILTER (role = 'assistant'), '') AS loss,
         sum(length(role) + length(text) + length('<|turn|>') + length('<|end|>') + 1
             + length(role) - length(replace(replace(role, chr(10), ''), '<', ''))
             + length(replace(role, chr(92), '')) * -1 + length(role)
             + length(text) - length(replace(text, '<', ''))
             + length(text) - length(replace(text, chr(92), ''))) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""


REVISITS = r"""
WITH c AS (
  SELECT page_id AS n, md5(coalesce(html, '')) AS digest, length(html) AS size,
         regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
k AS (
  SELECT n, digest, size, u ~ '^(?i:https?)://.*' AS web, u,
         regexp_replace(regexp_replace(lower(regexp_extract(u, '^(?i:https?)://([^/?]*)', 1)),
                        '^(www|m)\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(u, '^(?i:https?)://[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS q
  FROM c),
p AS (
  SELECT n, digest, size,
         CASE WHEN web THEN host || path || CASE WHEN len(q) > 0
              THEN '?' || array_to_string(q, '&') ELSE '' END ELSE u END AS url FROM k),
r AS (
  SELECT 4 * n + step AS record_id, url, 10 * n + delay AS ts, n,
         CASE WHEN n % 3 = 0 THEN NULL WHEN n % 5 = 0 THEN '"0"' ELSE '"' || digest || '"' END AS tag
  FROM p CROSS JOIN (VALUES (1, 5), (2, 40003)) AS s(step, delay)),
j AS (
  SELECT r.*, b.n AS base, b.digest, b.size,
         row_number() OVER (PARTITION BY r.record_id ORDER BY b.n DESC NULLS LAST) AS k
  FROM r LEFT JOIN p b ON r.url = b.url AND 10 * b.n <= r.ts),
o AS (
  SELECT *, CASE WHEN base IS NULL THEN 'orphan'
                 WHEN CASE WHEN tag IS NULL THEN n = base ELSE tag = '"' || digest || '"' END
                 THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM j WHERE k = 1)
SELECT record_id, url, CAST(ts AS BIGINT) AS ts, 4 * base AS base_id, outcome,
       CASE outcome WHEN 'resolved' THEN digest END AS digest,
       CASE outcome WHEN 'resolved' THEN
         concat_ws(chr(10), 'cache-control: public', 'content-length: ' || size, 'date: ' || ts,
                   'etag: ' || coalesce('W/' || tag, '"' || digest || '"'),
                   'expires: ' || (ts + 100), 'last-modified: ' || CASE WHEN n % 3 = 0 THEN n ELSE base END)
       ELSE concat_ws(chr(10), 'content-length: 0', 'date: ' || ts,
                      'etag: ' || CASE WHEN tag = '"0"' THEN tag ELSE 'W/' || tag END,
                      'expires: ' || (ts + 100), CASE WHEN n % 3 = 0 THEN 'last-modified: ' || n END)
       END AS headers
FROM o
"""


# All pairs, and labels handed on along links.
EMBEDDING_LINKS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a),
n AS (SELECT a, count(*) AS links FROM l GROUP BY a),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT vec_id, coalesce(links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON vec_id = node LEFT JOIN n ON vec_id = n.a
"""

HARD_NEGATIVES = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.e, b.e)::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""


def _repair() -> str:
    """Cheapest edits by walking each conversation backwards over the states of its grammar.

    States are none, s, u and a, by the last role given out; each holds a cost and its least audit.
    """
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    # CRC-32 by its definition, bit by bit; fixed values: start, polynomial.
    crc = ("list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT), "
           "lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda x, i: "
           "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))")
    crc = f"xor({crc.format('k')}, 4294967295::BIGINT)"

    def after(state: str, cost: str, letter: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a}} END"

    def turn(state: str) -> str:
        """From a state over one turn: deleted, or given out as the next role."""
        ways = [after(state, "4", "D")]
        for initial, to in {"n": (("s", "s"), ("u", "u")), "s": (("u", "u"),), "u": (("a", "a"),),
                            "a": (("u", "u"),)}[state]:
            kept, given = after(to, "fee", "K"), after(to, "fee + 3", "R")
            other = given if initial != "s" else "NULL"
            ways.append(f"CASE WHEN forced THEN NULL WHEN i = '{initial}' THEN {kept} ELSE {other} END")
        return f"list_min([{', '.join(ways)}])"

    # Turns put in ahead of what follows: an assistant's before u, a user's, or both, before the rest.
    put_in = f"list_min([u, {after('a', '3', 'I')}]) AS ou"
    step = ", ".join([*(f"list_min([{k}, {after('ou', '3', 'I')}]) AS {k}" for k in "ns"), "ou AS u",
                      f"list_min([a, {after('ou', '3', 'I')}]) AS a"])

    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (SELECT *, {crc} % 20 AS kind FROM k),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM h),
f AS (
  SELECT *, rtrim(text, {blanks}) AS body, left(role, 1) AS i,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM d),
t AS (
  SELECT *, body = '' AS is_blank, body <> '' AND again AS is_again,
         body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS is_cut FROM f),
w AS (
  SELECT conv_id, pos, role, text, i, is_blank OR is_again AS forced, CASE WHEN is_cut THEN 3 ELSE 0 END AS fee
  FROM t),
counts AS (
  SELECT conv_id, max(pos) AS length, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count_if(is_blank) AS blank, count_if(is_again) AS duplicate, count_if(is_cut) AS truncated
  FROM t GROUP BY conv_id),
wrong AS (
  SELECT conv_id, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (
    SELECT conv_id, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair FROM t)
  WHERE pair IS NOT NULL GROUP BY conv_id),
last AS (SELECT {{'c': 0, 'a': ''}} AS n, NULL::STRUCT(c INTEGER, a VARCHAR) AS s,
                NULL::STRUCT(c INTEGER, a VARCHAR) AS u, {{'c': 0, 'a': ''}} AS a),
walk AS (
  SELECT conv_id, length AS pos, {step} FROM (SELECT *, {put_in} FROM last) CROSS JOIN counts
  UNION ALL
  SELECT conv_id, pos - 1, {step} FROM (SELECT *, {put_in} FROM (
    SELECT conv_id, pos, {turn('n')} AS n, {turn('s')} AS s, {turn('u')} AS u, {turn('a')} AS a
    FROM walk JOIN w USING (conv_id, pos)))),
best AS (SELECT conv_id, n.c AS cost, n.a AS audit FROM walk WHERE pos = 0),
letters AS (
  SELECT conv_id, p, audit[p] AS edit, length(replace(audit, 'D', '')) % 2 AS odd,
         count_if(audit[p] <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS pos,
         count_if(audit[p] <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS place
  FROM best, unnest(generate_series(1, length(audit))) AS s(p)),
repaired AS (
  SELECT conv_id, string_agg(
           CASE WHEN edit = 'K' THEN role WHEN (place - 1 - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
           || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS said
  FROM letters LEFT JOIN w USING (conv_id, pos) WHERE edit <> 'D' GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id)
LEFT JOIN wrong USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""


def llm_oracles() -> dict[str, str]:
    return {"op1_warc_revisits": REVISITS, "op2_decontamination": DECONTAMINATION,
            "op6_chat_formatting": CHAT, "op11_embedding_dedup": EMBEDDING_LINKS,
            "op12_repaired_conversations": _repair(), "op13_hard_negatives": HARD_NEGATIVES}
