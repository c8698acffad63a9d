"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

import re

from quarry.llm.license_templates import PHRASES, TEMPLATES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUBSTRING = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
wins AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM starts),
rep AS (SELECT h FROM wins GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM wins JOIN rep USING (h)),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS x FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

SET_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END)) AS s FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 90 * (p.n + q.n - o)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT x, y FROM edges UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(reach.b), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id
"""


def _pattern(markup: str) -> str:
    """A template's mark-up rewritten as a regular expression, by text replacement alone (not by the operator's parser)."""
    marks = re.sub(r"\{\{(\d+),(\d+)\}\}", r" <\1;\2> ", markup.lower()).replace("[[", " ( ").replace("]]", " ) ")
    out = ""
    for x in re.sub(r"[^a-z0-9()<>;]+", " ", marks).split():
        lo, _, hi = x.strip("<>").partition(";")
        out += {"(": "(?:", ")": ")?"}.get(x) or (f"(?:[^ ]+ ){{{lo},{hi}}}" if hi else f"{x} ")
    return out


def _licenses() -> str:
    mentions = " || ".join(
        f"list_transform(list_filter(range(0, len(ws)), lambda i: ws[i + 1:i + {len(p.split())}] = {p.split()!r}), lambda i: {{'i': i, 'x': '{x}'}})"
        for p, x in PHRASES.items())
    templates = ", ".join(f"CASE WHEN regexp_matches(j, ' {_pattern(m)}') THEN '{x}' END" for x, m in TEMPLATES.items())
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
m AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS j, {mentions} AS b FROM w),
l AS (SELECT *, list_filter([{templates}], lambda x: x IS NOT NULL) AS t, list_transform(b, lambda s: s.x) AS bx, list_transform(b, lambda s: s.i) AS bi FROM m)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(b)::BIGINT AS n_base, list_min(bi)::BIGINT AS first_word, list_max(bi)::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(bx)), ',') AS base_labels, array_to_string(list_sort(list_distinct(bx || t)), ',') AS labels,
  CASE WHEN len(t) > 0 THEN 1.0 WHEN len(b) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM l
"""


VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
degree AS (SELECT x, count(*) AS n FROM edges GROUP BY x),
reach(a, b) AS (SELECT x, y FROM edges UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x),
part AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN degree ON x = vec_id LEFT JOIN part ON a = vec_id
"""



def _rendered(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '')"


def _mask(x: str) -> str:
    at = f"coalesce(list_sum(list_transform({x}[1:i - 1], lambda t: length(t.role) + length(t.text) + 13)), 0)::BIGINT + length({x}[i].role)"
    return (f"array_to_string(list_transform(list_filter(range(1, len({x}) + 1), lambda i: {x}[i].role = 'assistant'), "
            f"lambda i: ({at} + 5) || '-' || ({at} + length({x}[i].text) + 13)), ',')")


PREFERENCES = f"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '<\\|') AS role, replace(coalesce(text, ''), '<|', '<\\|') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id AS conv, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id),
a AS (SELECT *, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant') AS q FROM c),
leads AS (SELECT turns[1] AS f, min(conv) AS lead FROM c GROUP BY turns[1]),
pairs AS (
  SELECT 'opening' AS kind, lead AS chosen_id, c.conv AS rejected_id, l.turns AS x, c.turns AS y
  FROM c JOIN leads ON c.turns[1] = leads.f JOIN c l ON l.conv = leads.lead WHERE c.conv <> leads.lead
  UNION ALL
  SELECT 'stale', conv, conv, turns[1:list_max(q)], list_append(turns[1:list_max(q) - 1], turns[q[1]]) FROM a WHERE len(q) > 1),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(x), len(y)) + 1), lambda i: x[i] <> y[i])) - 1, least(len(x), len(y))) AS n FROM pairs),
s AS (SELECT *, x[n + 1:] AS xs, y[n + 1:] AS ys FROM n)
SELECT kind, chosen_id, rejected_id, n::INTEGER AS prompt_turns, {_rendered('x[1:n]')} AS prompt, {_rendered('xs')} AS chosen, {_rendered('ys')} AS rejected,
  {_mask('xs')} AS chosen_mask, {_mask('ys')} AS rejected_mask
FROM s
"""

def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _levels(name: str, key: str, leaves: str) -> str:
    """CTEs: all nodes of trees over ``leaves`` (key, i, h, n), and each run of siblings as a list."""
    return f"""
{name}({key}, lvl, i, h, n) AS (
  SELECT {key}, 0, i, h, n FROM {leaves}
  UNION ALL SELECT {key}, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY {key}, lvl, i // 3, n),
{name}_runs AS (SELECT {key}, lvl, i // 3 AS run, list(h ORDER BY i) AS hs FROM {name} WHERE n > 1 GROUP BY {key}, lvl, i // 3)"""


_UP = "sha256(array_to_string(list_transform(hs, lambda x, k: CASE WHEN k = i % 3 + 1 THEN f ELSE x END), ''))"
_SIBLINGS = "array_to_string(list_filter(hs, lambda x, k: k <> i % 3 + 1), '')"
_BARE = "replace(text, chr(10), '')"

MANIFEST = f"""
WITH RECURSIVE ids AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('1' || source, '0') AS g, {' || '.join(f'({_field(c)})' for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))} AS own,
    {' || '.join(f'({_field(c)})' for c in ('doc_id', 'source', 'lang', 'n_chars'))} AS head, text FROM documents),
leaf AS (SELECT rid, doc_id, g, sha256(own) AS h, head, text FROM ids),
base AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaf),
crc AS (SELECT doc_id, {{crc}} AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
{_levels('nodes', 'g', 'base')},
subs AS (SELECT g, h AS sub, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 'top' AS t, i, sub AS h, n FROM subs),
{_levels('top', 't', 'tops')},
up(rid, g, lvl, i, f, p) AS (
  SELECT rid, g, 0, i, CASE WHEN c % 2 = 0 AND text IS NOT NULL THEN sha256(head || strlen({_BARE}) || ':' || {_BARE}) ELSE h END, ''
  FROM base LEFT JOIN crc USING (doc_id)
  UNION ALL SELECT rid, up.g, up.lvl + 1, i // 3, {_UP}, p || {_SIBLINGS}
  FROM up JOIN nodes_runs r ON r.g = up.g AND r.lvl = up.lvl AND r.run = i // 3),
last AS (SELECT rid, g, f, p FROM up QUALIFY row_number() OVER (PARTITION BY rid ORDER BY lvl DESC) = 1),
over(rid, lvl, i, f, p) AS (
  SELECT rid, 0, i, f, p FROM last JOIN subs USING (g)
  UNION ALL SELECT rid, over.lvl + 1, i // 3, {_UP}, p || {_SIBLINGS} FROM over JOIN top_runs r ON r.lvl = over.lvl AND r.run = i // 3),
done AS (SELECT rid, f, p FROM over QUALIFY row_number() OVER (PARTITION BY rid ORDER BY lvl DESC) = 1),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, base.h AS leaf, sub AS subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified
FROM base JOIN subs USING (g) JOIN done USING (rid) CROSS JOIN root
"""

#: crc32 of a decimal number's digits: a table step a byte, from the polynomial alone.
_TABLE = "list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b, range(0, 8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda a, d: xor(a >> 8, ({_TABLE})[(xor(a, d) & 255) + 1])), 4294967295)"""
MANIFEST = MANIFEST.replace("{crc}", _CRC)

RANKED = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
uses AS (SELECT item_id, t, count(*) AS uses FROM q GROUP BY ALL),
size AS (SELECT count(*) AS cn, sum(len(ws))::BIGINT AS cl FROM d WHERE len(ws) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM uses) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * cn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), size),
post AS (SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * len(ws) * cn) // cl)))) AS s FROM tf JOIN d USING (r) JOIN w USING (t), size),
total AS (SELECT item_id, r, sum(uses * s)::BIGINT AS score FROM uses JOIN post USING (t) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INTEGER AS rank, doc_id, score FROM total JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

LLM_ORACLE: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING,
    "op3_set_join": SET_JOIN,
    "op4_license_templates": _licenses(),
    "op5_vector_cells": VECTORS,
    "op9_preference_pairs": PREFERENCES,
    "op12_postorder_manifest": MANIFEST,
    "op13_best_positions": RANKED,
}
