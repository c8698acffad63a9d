"""Independent SQL (DuckDB dialect) for every registered query.

Written from the semantics, not from the Spark code: tokens via
``string_split``, groups via SQL aggregates, loops via recursive CTEs.
"""

from __future__ import annotations

from quarry.constants import REPORT_HEADER, REPORT_LINE
from quarry.plans import inputs as I


def _sql_list(items: list[str]) -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in items) + "]"


KW = _sql_list(I.KEYWORDS)
KW_VALUES = "(VALUES " + ", ".join(f"('{k}', {i})" for i, k in enumerate(I.KEYWORDS)) + ") AS k(kw, pos)"
TOKENS = "string_split(regexp_replace(text, ' +$', ''), ' ')"

ORACLE: dict[str, str] = {}

ORACLE["kw_flag"] = "SELECT doc_id, " + ", ".join(
    f"list_contains({TOKENS}, '{k}') AS m{i}" for i, k in enumerate(I.KEYWORDS)) + " FROM documents"

ORACLE["kw_filter"] = f"SELECT doc_id FROM documents WHERE list_contains({TOKENS}, 'the')"

ORACLE["kw_pairs"] = f"""
SELECT k.kw, d.doc_id FROM documents d JOIN {KW_VALUES} ON list_contains({TOKENS}, k.kw)"""

ORACLE["kw_count_one"] = f"""
SELECT 'the' AS kw, count(*) FILTER (WHERE list_contains({TOKENS}, 'the')) AS n FROM documents"""

ORACLE["kw_rank_all"] = f"""
SELECT k.kw, count(d.doc_id) AS n
FROM {KW_VALUES} LEFT JOIN documents d ON list_contains(string_split(regexp_replace(d.text, ' +$', ''), ' '), k.kw)
GROUP BY k.kw"""

ORACLE["kw_index"] = f"""
SELECT k.kw, d.doc_id // 4096 AS block, list(d.doc_id ORDER BY d.doc_id) AS ids
FROM documents d JOIN {KW_VALUES} ON list_contains({TOKENS}, k.kw) GROUP BY k.kw, d.doc_id // 4096"""

_RANK = f"""
SELECT k.kw, count(*) AS n FROM documents d JOIN {KW_VALUES} ON list_contains({TOKENS}, k.kw) GROUP BY k.kw"""
ORACLE["kw_rank_index"] = _RANK
ORACLE["kw_rank"] = _RANK
ORACLE["kw_rank_table"] = _RANK

ORACLE["article_parse"] = """
SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents"""

# ---------------------------------------------------------------- postings / k-means
LANGS = _sql_list(I.LANGS)
SP = I.LANG_SPREAD
PER = I.KERNELS // len(I.LANGS)
SEED = I.SAMPLE_SEED


def _d2(ax, ay, bx, by):
    return (f"((CAST({ax} AS DOUBLE) - {bx}) * (CAST({ax} AS DOUBLE) - {bx}) + "
            f"(CAST({ay} AS DOUBLE) - {by}) * (CAST({ay} AS DOUBLE) - {by}))")


ORACLE["posting_parse"] = """
SELECT 1 AS type, o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 + 1 END AS accepted,
       CAST(NULL AS BIGINT) AS parent_id, 0 AS score, o_orderpriority AS tags FROM orders
UNION ALL
SELECT 2, l_orderkey * 10 + l_linenumber, NULL, l_orderkey, CAST(trunc(l_quantity) AS INTEGER) - 25, NULL FROM lineitem"""

_QA = """
q AS (SELECT o_orderkey AS qid, o_orderpriority AS tags FROM orders),
a AS (SELECT l_orderkey AS qid, CAST(trunc(l_quantity) AS INTEGER) - 25 AS score FROM lineitem)"""

_VEC = _QA + f""",
scored AS (SELECT q.qid, q.tags, greatest(max(a.score), 0) AS high_score
           FROM q JOIN a ON a.qid = q.qid GROUP BY q.qid, q.tags),
vec AS (SELECT qid, CAST((list_position({LANGS}, tags) - 1) * {SP} AS INTEGER) AS x, high_score AS y FROM scored),
samp AS (SELECT qid, x, y FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY md5('{SEED}:' || qid), qid) AS rn
                                FROM vec) WHERE rn <= {PER}),
init AS (SELECT CAST(row_number() OVER (ORDER BY x, md5('{SEED}:' || qid), qid) - 1 AS INTEGER) AS i, x, y FROM samp)"""

ORACLE["posting_files"] = ORACLE["posting_parse"]
ORACLE["qa_pairs"] = f"WITH {_QA} SELECT q.qid, q.tags, a.score FROM q JOIN a ON a.qid = q.qid"
ORACLE["qa_grouped"] = f"""WITH {_QA}
SELECT q.qid, q.tags, count(*) AS n_answers, max(a.score) AS max_score, min(a.score) AS min_score
FROM q JOIN a ON a.qid = q.qid GROUP BY q.qid, q.tags"""
ORACLE["qa_groups"] = """
WITH a AS (SELECT o_custkey % 5 AS qid, o_orderkey AS id, CAST(floor(o_totalprice) AS INTEGER) AS score FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY md5(id::VARCHAR), id, score) - 1 AS idx FROM a)
SELECT CAST(qid AS BIGINT) AS qid, r_name AS tags, CAST(idx // 1000 AS BIGINT) AS block, string_agg(idx || ':' || id || ':' || score, ',' ORDER BY idx) AS answers
FROM n JOIN region ON r_regionkey = qid GROUP BY qid, r_name, idx // 1000"""
ORACLE["qa_dropped"] = f"""
WITH p AS (SELECT l_orderkey AS qid, CAST(trunc(l_quantity) AS INTEGER) - 25 AS score FROM lineitem),
s AS (SELECT qid, o_orderpriority AS tags FROM p JOIN orders ON o_orderkey = qid WHERE score % 7 <> 0 GROUP BY qid, o_orderpriority)
SELECT 'vectors' AS what, count(*) AS n FROM s WHERE tags <> '{I.LANGS[0]}'
UNION ALL SELECT 'answer without parent', count(*) FROM p WHERE score % 7 = 0
UNION ALL SELECT 'question with unknown tag', count(*) FROM s WHERE tags = '{I.LANGS[0]}'"""
ORACLE["qa_scored"] = f"WITH {_VEC} SELECT qid, tags, high_score FROM scored"
ORACLE["vectors"] = f"WITH {_VEC} SELECT qid, x, y FROM vec"
ORACLE["vectors_joined"] = ORACLE["vectors"]
ORACLE["vector_count"] = f"WITH {_VEC} SELECT count(*) AS n FROM vec"
ORACLE["sample_per_group"] = f"WITH {_VEC} SELECT qid, x, y FROM samp"
ORACLE["sample_global"] = f"WITH {_VEC} SELECT qid, x, y FROM vec ORDER BY md5('{SEED}:' || qid), qid LIMIT {I.KERNELS}"
ORACLE["kmeans_init"] = f"WITH {_VEC} SELECT i, x, y FROM init"
ORACLE["kmeans_assign"] = f"""WITH {_VEC}
SELECT v.qid, v.x, v.y, first(m.i ORDER BY {_d2('v.x', 'v.y', 'm.x', 'm.y')}, m.i) AS cluster
FROM vec v, init m GROUP BY v.qid, v.x, v.y"""

ORACLE["kmeans_assign_table"] = f"""
WITH p AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS INTEGER) AS x, CAST(l_partkey AS INTEGER) AS y FROM lineitem),
c AS (SELECT CAST(c_custkey AS INTEGER) AS i, CAST(floor(c_acctbal * 10) AS INTEGER) AS cx, CAST(c_custkey AS INTEGER) AS cy FROM customer),
d AS (SELECT x, y, min({{'d': {_d2('x', 'y', 'cx', 'cy')}, 'i': i}}).i AS cluster FROM (SELECT DISTINCT x, y FROM p), c GROUP BY x, y)
SELECT l_orderkey, l_linenumber, x, y, cluster FROM p JOIN d USING (x, y)"""
ORACLE["weighted_median"] = """
WITH v AS (SELECT l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(sum(trunc(l_quantity)) AS BIGINT) AS w FROM lineitem GROUP BY ALL),
r AS (SELECT *, sum(w) OVER (PARTITION BY l_returnflag ORDER BY cents) AS upto, sum(w) OVER (PARTITION BY l_returnflag) AS n FROM v)
SELECT l_returnflag, avg(cents)::DOUBLE AS median FROM r WHERE (upto - w <= (n - 1) // 2 AND (n - 1) // 2 < upto) OR (upto - w <= n // 2 AND n // 2 < upto)
GROUP BY l_returnflag"""

_STEP = f""",
asg0 AS (SELECT v.x, v.y, first(m.i ORDER BY {_d2('v.x', 'v.y', 'm.x', 'm.y')}, m.i) AS ci
         FROM vec v, init m GROUP BY v.qid, v.x, v.y),
nm0 AS (SELECT ci AS i, CAST(sum(CAST(x AS BIGINT)) // count(*) AS INTEGER) AS nx,
               CAST(sum(CAST(y AS BIGINT)) // count(*) AS INTEGER) AS ny FROM asg0 GROUP BY ci),
step1 AS (SELECT init.i, coalesce(nx, init.x) AS x, coalesce(ny, init.y) AS y, init.x AS ox, init.y AS oy
          FROM init LEFT JOIN nm0 ON nm0.i = init.i)"""
ORACLE["kmeans_step"] = f"WITH {_VEC}{_STEP} SELECT i, x, y FROM step1"
ORACLE["kmeans_shift"] = f"WITH {_VEC}{_STEP} SELECT sum({_d2('x', 'y', 'ox', 'oy')}) AS shift FROM step1"

_FIT = f""",
pts AS (SELECT x, y, count(*) AS w FROM vec GROUP BY x, y),
it(n, i, x, y, ox, oy, done, conv) AS (
  SELECT 0, i, x, y, x, y, false, false FROM init
  UNION ALL (
    WITH cur AS (SELECT n, i, x, y FROM it WHERE NOT done),
    asg AS (SELECT p.x, p.y, p.w, first(c.i ORDER BY {_d2('p.x', 'p.y', 'c.x', 'c.y')}, c.i) AS ci
            FROM pts p, cur c GROUP BY p.x, p.y, p.w),
    nm AS (SELECT ci AS i, CAST(sum(CAST(x AS BIGINT) * w) // sum(w) AS INTEGER) AS nx,
                  CAST(sum(CAST(y AS BIGINT) * w) // sum(w) AS INTEGER) AS ny FROM asg GROUP BY ci),
    nxt AS (SELECT cur.n + 1 AS n, cur.i, coalesce(nm.nx, cur.x) AS x, coalesce(nm.ny, cur.y) AS y,
                   cur.x AS ox, cur.y AS oy FROM cur LEFT JOIN nm ON nm.i = cur.i),
    sh AS (SELECT sum({_d2('x', 'y', 'ox', 'oy')}) AS s FROM nxt)
    SELECT nxt.n, nxt.i, nxt.x, nxt.y, nxt.ox, nxt.oy, (sh.s < {I.ETA} OR nxt.n >= {I.MAX_ITERATIONS}), sh.s < {I.ETA} FROM nxt, sh
  )
),
fm AS (SELECT i, x, y FROM it WHERE done),
state AS (SELECT any_value(n) AS iterations, any_value(conv) AS converged FROM it WHERE done)"""

ORACLE["kmeans_fit"] = f"WITH RECURSIVE {_VEC}{_FIT} SELECT i, x, y, iterations, converged FROM fm, state"
ORACLE["kmeans_trace"] = f"""WITH RECURSIVE {_VEC}{_FIT}
SELECT n AS iter, i, ox AS old_x, oy AS old_y, x AS new_x, y AS new_y, {_d2('ox', 'oy', 'x', 'y')} AS shift
FROM it WHERE n > 0"""

_REPORT = f""",
casg AS (SELECT v.x, v.y, first(m.i ORDER BY {_d2('v.x', 'v.y', 'm.x', 'm.y')}, m.i) AS cluster
         FROM vec v, fm m GROUP BY v.qid, v.x, v.y),
per_lang AS (SELECT cluster, x, count(*) AS n FROM casg GROUP BY cluster, x),
dom AS (SELECT cluster, first(x ORDER BY n DESC, x) AS dom_x, max(n) AS dom_n, sum(n) AS size
        FROM per_lang GROUP BY cluster),
med AS (SELECT cluster, CAST(trunc(median(y)) AS INTEGER) AS median FROM casg GROUP BY cluster),
rep AS (SELECT dom.cluster, {LANGS}[dom_x // {SP} + 1] AS label,
               (CAST(dom_n AS DOUBLE) / size) * 100 AS percent, CAST(size AS BIGINT) AS size, median
        FROM dom JOIN med ON med.cluster = dom.cluster)"""

ORACLE["cluster_report"] = f"WITH RECURSIVE {_VEC}{_FIT}{_REPORT} SELECT rep.*, iterations, converged FROM rep, state"
ORACLE["cluster_report_digits"] = ORACLE["cluster_report"]
ORACLE["kmeans_job"] = ORACLE["cluster_report"]
_HEADER = ", ".join(f"({i}, '{t}')" for i, t in enumerate(REPORT_HEADER))
ORACLE["cluster_report_text"] = f"""WITH RECURSIVE {_VEC}{_FIT}{_REPORT},
lines AS (SELECT * FROM (VALUES {_HEADER}) AS h(line_no, line)
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY median, cluster) + {len(REPORT_HEADER) - 1} AS INTEGER) AS line_no,
       printf('{REPORT_LINE}', median, label, round(percent, 1), size) AS line FROM rep)
SELECT lines.*, iterations, converged FROM lines, state"""

# ---------------------------------------------------------------- wide survey
_WIDE_COLS = ["tucaseid", "telfs", "tesex", "teage", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
              "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_WIDE = """wide AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tucaseid,
         CAST(l_linenumber AS DOUBLE) AS telfs, CAST(l_suppkey % 2 + 1 AS DOUBLE) AS tesex,
         CAST(l_quantity AS DOUBLE) AS teage, CAST(l_orderkey AS DOUBLE) AS l_orderkey,
         CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey,
         CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem)"""
_SUMMARY = _WIDE + """,
summary AS (
  SELECT CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage >= 15 AND teage <= 22 THEN 'young'
              WHEN teage >= 23 AND teage <= 55 THEN 'active' ELSE 'elder' END AS age,
         l_extendedprice / 60 AS primaryNeeds,
         (l_quantity + l_tax) / 60 AS work,
         (l_orderkey + l_partkey + l_suppkey + l_linenumber + l_discount) / 60 AS other
  FROM wide WHERE telfs <= 4)"""

ORACLE["wide_schema"] = f"WITH {_WIDE} " + " UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS name, '{'string' if i == 0 else 'double'}' AS type, "
    f"count(*) - count({c}) AS nulls FROM wide" for i, c in enumerate(_WIDE_COLS))
_GROUPS = {"l_extendedprice": "primary", "l_quantity": "work", "l_tax": "work", "l_orderkey": "other",
           "l_partkey": "other", "l_suppkey": "other", "l_linenumber": "other", "l_discount": "other"}
ORACLE["wide_classify"] = f"WITH {_WIDE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS name, '{g}' AS grp, count({c}) AS n_values FROM wide" for c, g in _GROUPS.items())
ORACLE["wide_files"] = f"WITH {_WIDE} SELECT * FROM wide"
ORACLE["wide_summary"] = f"WITH {_SUMMARY} SELECT * FROM summary"
ORACLE["wide_typed"] = ORACLE["wide_summary"]
ORACLE["wide_grouped"] = f"""WITH {_SUMMARY}
SELECT working, sex, age, round(avg(primaryNeeds), 1) AS primaryNeeds, round(avg(work), 1) AS work,
       round(avg(other), 1) AS other FROM summary GROUP BY working, sex, age"""
ORACLE["wide_grouped_sql"] = ORACLE["wide_grouped"]
ORACLE["wide_grouped_typed"] = ORACLE["wide_grouped"]

# ---------------------------------------------------------------- record sets
def _to_set(where: str = "TRUE") -> str:
    return f"""(SELECT arg_min(source, doc_id) AS user, text, CAST(arg_min(n_chars, doc_id) AS INTEGER) AS retweets
       FROM documents WHERE {where} GROUP BY text)"""


_SET = _to_set()
ORACLE["set_from_list"] = f"SELECT * FROM {_SET}"
ORACLE["set_union"] = f"""WITH l AS {_to_set("lang IN ('en', 'fr')")}, r AS {_to_set("lang IN ('fr', 'de', 'es')")}
SELECT * FROM r UNION ALL SELECT * FROM l WHERE text NOT IN (SELECT text FROM r)"""
ORACLE["set_union_all"] = """
SELECT first(source ORDER BY CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) DESC, doc_id) AS user, text,
       CAST(first(n_chars ORDER BY CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) DESC, doc_id) AS INTEGER) AS retweets
FROM documents GROUP BY text"""
ORACLE["set_size"] = "SELECT count(DISTINCT text) AS n FROM documents"
ORACLE["set_filter"] = f"SELECT * FROM {_SET} WHERE retweets >= 5000"
ORACLE["set_contains"] = """
SELECT conv_id, turn, text IN (SELECT text FROM documents) AS contained FROM conversations"""
ORACLE["set_remove"] = f"SELECT * FROM {_SET} WHERE text NOT IN (SELECT text FROM documents WHERE lang = 'de')"
ORACLE["set_most"] = f"SELECT * FROM {_SET} ORDER BY retweets DESC, text LIMIT 1"
ORACLE["set_desc"] = ORACLE["set_from_list"]
ORACLE["set_head_tail"] = f"""WITH s AS {_SET}
SELECT s.*, s.text = (SELECT text FROM s ORDER BY retweets DESC, text LIMIT 1) AS is_head FROM s"""
ORACLE["set_render"] = f"""SELECT 'User: ' || user || chr(10) || 'Text: ' || text || ' [' || CAST(retweets AS VARCHAR) || ']' AS line
FROM {_SET}"""
ORACLE["topic_filter"] = f"SELECT * FROM {_SET} WHERE contains(text, 'the') OR contains(text, 'The')"
_TOPICS = "(SELECT DISTINCT item_id AS topic, unnest(regexp_extract_all(text, '\\p{L}+')) AS kw FROM benchmark)"
ORACLE["set_page"] = f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY retweets DESC, text) - 1 AS rank FROM {_SET})
WHERE rank >= 100 AND rank < 150"""
ORACLE["topic_table"] = f"""SELECT seq, topic, count(*) AS n_keywords FROM (SELECT min(doc_id) AS seq, text FROM documents GROUP BY text) JOIN {_TOPICS} ON contains(text, kw) AND length(kw) >= 5 GROUP BY seq, topic"""
ORACLE["topic_table_trending"] = f"""SELECT * FROM {_SET} s WHERE EXISTS (SELECT 1 FROM {_TOPICS} WHERE length(kw) >= 12 AND contains(s.text, kw))"""
ORACLE["topic_trending"] = f"""SELECT * FROM {_SET}
WHERE contains(text, 'the') OR contains(text, 'The') OR contains(text, 'le') OR contains(text, 'Le')"""

# ---------------------------------------------------------------- key sets, sums
_KA = "(SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_partkey IS NOT NULL)"
_KB = "(SELECT DISTINCT p_partkey AS k FROM part WHERE p_partkey IS NOT NULL)"
ORACLE["keyset_union"] = f"SELECT k FROM {_KA} UNION SELECT k FROM {_KB}"
ORACLE["keyset_intersect"] = f"SELECT k FROM {_KA} INTERSECT SELECT k FROM {_KB}"
ORACLE["keyset_diff"] = f"SELECT k FROM {_KA} EXCEPT SELECT k FROM {_KB}"
ORACLE["keyset_filter"] = f"SELECT k FROM {_KA} WHERE k BETWEEN 500 AND 1500"
ORACLE["keyset_map"] = f"SELECT DISTINCT k // 10 AS k FROM {_KA}"
ORACLE["keyset_forall"] = f"SELECT coalesce(bool_and(k > 0), true) AS forall FROM {_KA}"
ORACLE["keyset_exists"] = f"SELECT coalesce(bool_or(k > 1900), false) AS exists FROM {_KA}"
ORACLE["keyset_contains"] = f"""SELECT p.k, p.k IN (SELECT k FROM {_KA}) AS contained
FROM (SELECT DISTINCT p_partkey AS k FROM part) p"""
ORACLE["keyset_render"] = f"""SELECT CAST(floor(k / 1000) * 1000 AS BIGINT) AS lo, '{{' || string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) || '}}' AS text
FROM {_KB} GROUP BY floor(k / 1000)"""
ORACLE["sql_keysets"] = f"SELECT DISTINCT k // 10 AS k FROM {_KA} WHERE k BETWEEN 500 AND 1500"
ORACLE["sql_keyset_tests"] = f"""SELECT 'forall' AS what, coalesce(bool_and(k > 0), true) AS holds FROM {_KA}
UNION ALL SELECT 'exists', coalesce(bool_or(k > 1900), false) FROM {_KA}"""
ORACLE["list_sum"] = "SELECT CAST(coalesce(sum(o_custkey), 0) AS BIGINT) AS total FROM orders"
ORACLE["list_max"] = "SELECT max(o_custkey) AS maximum FROM orders"

# ---------------------------------------------------------------- json
ORACLE["json_scan"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
ORACLE["json_records"] = "SELECT source AS user, text, CAST(n_chars AS INTEGER) AS retweets FROM documents"
ORACLE["json_write"] = """
SELECT CAST(to_json(struct_pack("user" := source, "text" := text, "retweets" := CAST(n_chars AS INTEGER))) AS VARCHAR) AS json
FROM documents"""

ORACLE["json_store"] = "SELECT source AS user, text, CAST(n_chars AS INTEGER) AS retweets, doc_id AS seq, source FROM documents"
ORACLE["json_store_replaced"] = """SELECT source AS user, text, CAST(CASE WHEN source = 'src1' THEN 2 * n_chars ELSE n_chars END AS INTEGER) AS retweets,
       doc_id AS seq, source FROM documents"""
ORACLE["json_store_site"] = ORACLE["json_store"] + " WHERE source = 'src3'"

ORACLE["json_unparse"] = """
SELECT '{ "user": "' || source || '", "text": "' || replace(text, '"', '\\"') || '", "retweets": '
       || CAST(n_chars AS VARCHAR) || '.0 },' AS line
FROM documents"""

# ---------------------------------------------------------------- signatures
def _sig(expr: str) -> str:
    return f"array_to_string(list_sort(string_split(lower({expr}), '')), '')"


def _cnt(s: str, c: str) -> str:
    return f"(length({s}) - length(replace({s}, {c}, '')))"


_WORDS = """(SELECT lower(w) AS word FROM (SELECT unnest(regexp_split_to_array(text, '[^\\p{L}]+')) AS w FROM documents)
  WHERE w <> '')"""
_BWORDS = """(SELECT lower(w) AS word FROM (SELECT unnest(regexp_split_to_array(text, '[^\\p{L}]+')) AS w FROM benchmark)
  WHERE w <> '')"""
_DICT = f"(SELECT DISTINCT {_sig('word')} AS sig, word FROM {_WORDS})"
ORACLE["word_files"] = f"SELECT DISTINCT word FROM {_WORDS}"
ORACLE["word_signature"] = f"SELECT DISTINCT word, {_sig('word')} AS sig FROM {_WORDS}"
ORACLE["signature_dictionary"] = f"SELECT * FROM {_DICT}"
ORACLE["word_anagrams"] = f"""
SELECT q.word, q.sig, coalesce(d.word, '') AS anagram
FROM (SELECT DISTINCT word, {_sig('word')} AS sig FROM {_BWORDS}) q LEFT JOIN {_DICT} d ON d.sig = q.sig"""
_NOSPACE = "replace(p_name, ' ', '')"
_SENT = f"(SELECT DISTINCT p_name AS sentence, {_sig(_NOSPACE)} AS sig FROM part)"
_TEXTS = f"""(SELECT DISTINCT trim(s) AS sentence FROM (SELECT unnest(regexp_split_to_array(text, '[.\\n]')) AS s FROM documents)
  WHERE trim(s) <> '')"""
_SPACELESS = "replace(sentence, ' ', '')"
_TSENT = f"(SELECT sentence, {_sig(_SPACELESS)} AS sig FROM {_TEXTS})"
ORACLE["sentence_signature"] = f"SELECT sentence, sig FROM {_TSENT}"
ORACLE["multiset_subtract"] = f"""
SELECT sentence, x, y, array_to_string(list_transform(list_sort(list_distinct(string_split(x, ''))),
         lambda c: repeat(c, CASE WHEN {_cnt('y', 'c')} <= {_cnt('x', 'c')} THEN {_cnt('x', 'c')} - {_cnt('y', 'c')}
                                  ELSE {_cnt('x', 'c')} END)), '') AS rest
FROM (SELECT sentence, sig AS x, {_sig("string_split(sentence, ' ')[1]")} AS y FROM {_TSENT})"""
ORACLE["sub_multisets"] = f"""
WITH RECURSIVE letters AS (
  SELECT sentence, sig, c, {_cnt('sig', 'c')} AS n, row_number() OVER (PARTITION BY sentence ORDER BY c) AS k
  FROM (SELECT sentence, sig, unnest(list_distinct(string_split(sig, ''))) AS c FROM {_SENT} WHERE sig <> '')),
subs(sentence, k, sub) AS (
  SELECT sentence, 0, '' FROM {_SENT}
  UNION ALL
  SELECT s.sentence, s.k + 1, s.sub || repeat(l.c, j.j)
  FROM subs s JOIN letters l ON l.sentence = s.sentence AND l.k = s.k + 1, range(0, 64) j(j) WHERE j.j <= l.n)
SELECT s.sentence, s.sub FROM subs s
WHERE s.k = (SELECT coalesce(max(k), 0) FROM letters l WHERE l.sentence = s.sentence)"""
_NWORDS = f"""(SELECT DISTINCT w AS word, {_sig('w')} AS sig
  FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE w <> '')"""
ORACLE["sentence_anagrams"] = f"""
WITH RECURSIVE d AS {_NWORDS},
st(sentence, path, rem) AS (
  SELECT sentence, CAST([] AS VARCHAR[]), sig FROM {_SENT}
  UNION ALL
  SELECT st.sentence, list_append(st.path, d.word),
         array_to_string(list_transform(list_sort(list_distinct(string_split(st.rem, ''))),
           lambda c: repeat(c, {_cnt('st.rem', 'c')} - {_cnt('d.sig', 'c')})), '')
  FROM st JOIN d ON d.sig <> '' AND list_bool_and(list_transform(string_split(d.sig, ''),
                       lambda c: {_cnt('d.sig', 'c')} <= {_cnt('st.rem', 'c')}))
  WHERE st.rem <> '')
SELECT sentence, array_to_string(path, ' ') AS anagram FROM st WHERE rem = ''"""

# ---------------------------------------------------------------- characters
_CHARS = "(SELECT unnest(string_split(text, '')) AS ch FROM documents WHERE text <> '')"
ORACLE["char_freq"] = f"SELECT ch, count(*) AS n FROM {_CHARS} GROUP BY ch"
ORACLE["char_freq_ordered"] = f"""
SELECT ch, n, row_number() OVER (ORDER BY n, ch) - 1 AS pos FROM (SELECT ch, count(*) AS n FROM {_CHARS} GROUP BY ch)"""


def _codes(tbl: str, col: str) -> str:
    return f"""(SELECT ch, lpad(bin(row_number() OVER (ORDER BY n DESC, ch) - 1),
                      CAST(greatest(1, length(bin(count(*) OVER () - 1))) AS INTEGER), '0') AS bits
  FROM (SELECT ch, count(*) AS n FROM (SELECT unnest(string_split({col}, '')) AS ch FROM {tbl} WHERE {col} <> '')
        GROUP BY ch))"""


ORACLE["code_apply"] = f"""
WITH codes AS {_codes('part', 'p_name')},
chars AS (SELECT p_partkey, unnest(string_split(p_name, '')) AS ch,
                 unnest(range(1, length(p_name) + 1)) AS pos FROM part)
SELECT p_partkey, string_agg(bits, '' ORDER BY pos) AS bits FROM chars JOIN codes USING (ch) GROUP BY p_partkey"""
ORACLE["code_merge"] = f"""
WITH a AS {_codes('part', 'p_name')}, b AS {_codes('supplier', 's_name')}
SELECT ch, bits FROM a UNION ALL SELECT ch, bits FROM b WHERE ch NOT IN (SELECT ch FROM a)"""
ORACLE["balanced_text"] = """
WITH p AS (SELECT doc_id, regexp_replace(text, '[^()]', '', 'g') AS s FROM documents),
c AS (SELECT doc_id, s, unnest(range(1, length(s) + 1)) AS i FROM p),
r AS (SELECT doc_id, sum(CASE WHEN substr(s, i, 1) = '(' THEN 1 ELSE -1 END)
                     OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM c),
m AS (SELECT doc_id, min(depth) AS lo FROM r GROUP BY doc_id)
SELECT p.doc_id, coalesce(m.lo, 0) >= 0
       AND length(replace(p.s, ')', '')) = length(replace(p.s, '(', '')) AS balanced
FROM p LEFT JOIN m ON m.doc_id = p.doc_id"""

# ---------------------------------------------------------------- as SQL text
ORACLE["sql_mentions"] = f"""SELECT doc_id, list_contains({TOKENS}, 'the') AS whole, contains(text, 'le') OR contains(text, 'Le') AS part FROM documents"""
ORACLE["sql_signature"] = ORACLE["word_signature"]
ORACLE["sql_subtract"] = f"""
SELECT sentence, x, y, array_to_string(list_transform(list_sort(list_distinct(string_split(x, ''))),
         lambda c: repeat(c, CASE WHEN {_cnt('y', 'c')} <= {_cnt('x', 'c')} THEN {_cnt('x', 'c')} - {_cnt('y', 'c')}
                                  ELSE {_cnt('x', 'c')} END)), '') AS rest
FROM (SELECT sentence, sig AS x, {_sig("string_split(sentence, ' ')[1]")} AS y FROM {_SENT})"""
ORACLE["sql_balanced"] = ORACLE["balanced_text"]
