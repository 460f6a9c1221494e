"""DuckDB SQL of the operators over benchmark items, conversations and vectors, in the form of their queries."""

from __future__ import annotations

from loghelm.llm import chat_buffers as chat
from loghelm.llm.positional_index import WINDOW
from loghelm.llm.slice_masks import ENTRIES, PARTS, ROUNDS, SCALE

#: The conversation that op13 adds: its text holds marks of the template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"

_CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda a, k: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END), b)) AS crc
)"""
_CRC_OF = """xor(list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i::INT, 1))::BIGINT),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""

TRIE = f"""
WITH {_CRC},
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, sha256(strlen(role)::VARCHAR || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id
),
heads AS (SELECT own.*, ({_CRC_OF.format("conv_id::VARCHAR")} % 4) AS h FROM own, crc_table),
made AS (
  SELECT a.conv_id, coalesce(b.turns[1:a.h], []) || coalesce(a.turns[a.h + 1:], []) AS turns
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
),
steps AS (SELECT conv_id AS conv, turns, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth FROM made),
members AS (
  SELECT conv, size, depth, turns[depth].text AS last, min(conv) OVER (PARTITION BY depth, turns[1:depth]) AS rep FROM steps
),
nodes AS (
  SELECT rep, depth, count(*) AS n, (count(*) - 1) * any_value(CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(last, '[^\x20\x09-\x0D]+')) END) AS saved,
    sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (WHERE size = depth), '')) AS ends
  FROM members GROUP BY rep, depth
),
parents AS (
  SELECT n.*, m.rep AS parent FROM nodes n LEFT JOIN members m ON m.conv = n.rep AND m.depth = n.depth - 1
),
children AS (SELECT parent AS rep, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
own_figures AS (SELECT p.*, coalesce(c.n_children, 0) AS n_children FROM parents p LEFT JOIN children c USING (rep, depth)),
sums AS (
  SELECT m.rep, m.depth, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum(f.saved)::BIGINT AS saved_tokens
  FROM own_figures f JOIN members m ON m.conv = f.rep AND m.depth <= f.depth GROUP BY m.rep, m.depth
)
SELECT rep AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved_tokens, ends AS ends_sha256
FROM own_figures JOIN sums USING (rep, depth)
"""


def contamination_sql(window: int = WINDOW) -> str:
    """Every run of words of a document beside every window of an item, as texts."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = "(SELECT *, unnest(range(1, len(words) - size + 2)) AS place FROM {0})"
    run_of = "array_to_string(words[place:place + size - 1], ' ')"
    return f"""
WITH docs AS MATERIALIZED (SELECT doc_id, coalesce({words}, []) AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item_id, {words} AS words FROM benchmark WHERE text IS NOT NULL),
cut AS (SELECT *, least(len(words), {window}) AS size FROM items WHERE len(words) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, size, {run_of} AS run FROM {runs.format("cut")}),
sized AS (SELECT * FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size),
found AS MATERIALIZED (
  SELECT doc_id, place, size, item_id FROM (SELECT doc_id, place, size, {run_of} AS run FROM {runs.format("sized")}) JOIN windows USING (size, run)
),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(place, place + size)) AS word FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """Rounds written out one after the other."""
    distance = "list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)"

    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, p, x, arg_min(e, (gap, e)) AS e, min(gap)::BIGINT AS error
  FROM (SELECT vec_id, p, x, e, {distance} AS gap FROM cut JOIN b{k} USING (p)) GROUP BY vec_id, p, x
)"""

    steps = []
    for k in range(rounds):
        steps.append(assigned(k))
        steps.append(f"""
m{k} AS (SELECT p, e, j, floor(sum(x[j]) / count(*)) AS c FROM (SELECT *, unnest(range(1, len(x) + 1)) AS j FROM a{k}) GROUP BY p, e, j),
b{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(made.c, old.c) AS c FROM b{k} old LEFT JOIN (SELECT p, e, list(c ORDER BY j) AS c FROM m{k} GROUP BY p, e) made USING (p, e)
)""")
    steps.append(assigned(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cut AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM (SELECT *, unnest(range({parts})) AS p FROM kept)
),
b0 AS MATERIALIZED (
  SELECT p, e, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut) WHERE e < {entries}
),{",".join(steps)},
digest AS (
  SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS j FROM b{rounds})
),
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(error)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


def chat_sql() -> str:
    escape = lambda c: f"regexp_replace({c}, '{chat.ESCAPE}', '\\1\\\\\\2\\3', 'g')"
    marks = "".join(f"WHEN '{role}' THEN {len(a + b)} " for role, (a, b) in chat.MARKS.items())
    other = f"{len(chat.ROLE + chat.END_ROLE + chat.END_TURN)} + length({escape('role')})"
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' {order}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length({escape('text')}) + CASE role {marks}ELSE {other} END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
