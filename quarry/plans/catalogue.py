"""Registered queries: name → callable(spark, sf_dir) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import sql as fsql
from quarry.functions.text import signature
from quarry.operators import basics as bs
from quarry.operators import char_stats as cs
from quarry.operators import cluster_report as cr
from quarry.operators import key_sets as ks
from quarry.operators import keyword_rank as kr
from quarry.operators import kmeans as km
from quarry.operators import nearest_centres as nc
from quarry.operators import pattern_index as pi
from quarry.operators import qa_scores as qa
from quarry.operators import ranked_list as rl
from quarry.operators import record_sets as rs
from quarry.operators import sampling as smp
from quarry.operators import selection as sel
from quarry.operators import signatures as sg
from quarry.operators import wide_summary as ws
from quarry.plans import inputs as I
from quarry.session import release, shared_folder
from quarry.sources import json as sj
from quarry.sources import tables as tbl
from quarry.sources import text as src_text

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- keywords
@query("kw_flag")
def _kw_flag(spark, sf):
    return kr.flag_mentions(I.articles(spark, sf), I.KEYWORDS).select("doc_id", "flags.*")


@query("kw_filter")
def _kw_filter(spark, sf):
    return kr.articles_mentioning(I.articles(spark, sf), "the").select("doc_id")


@query("kw_pairs")
def _kw_pairs(spark, sf):
    return kr.keyword_pairs(I.articles(spark, sf), I.KEYWORDS)


@query("kw_count_one")
def _kw_count_one(spark, sf):
    return kr.count_mentions(I.articles(spark, sf), "the")


@query("kw_rank_all")
def _kw_rank_all(spark, sf):
    return kr.rank_all(I.articles(spark, sf), I.KEYWORDS)


@query("kw_index")
def _kw_index(spark, sf):
    return kr.make_index(I.articles(spark, sf), I.KEYWORDS)


@query("kw_rank_index")
def _kw_rank_index(spark, sf):
    return kr.rank_from_index(kr.make_index(I.articles(spark, sf), I.KEYWORDS))


@query("kw_rank")
def _kw_rank(spark, sf):
    return kr.rank_reduce(I.articles(spark, sf), I.KEYWORDS)


@query("kw_rank_table")
def _kw_rank_table(spark, sf):
    """D5 with the keyword list given as a table (join path)."""
    return kr.rank_reduce(I.articles(spark, sf), kr.keyword_table(spark, I.KEYWORDS))


@query("article_parse")
def _article_parse(spark, sf):
    parsed = src_text.parse_articles(I.article_lines(spark, sf))
    return parsed.select(F.col("title"), F.col("text"))


# ---------------------------------------------------------------- postings / k-means


def _vectors(spark, sf, from_text: bool = False):
    """Vectors by the fused co-grouping aggregate (one scan, one shuffle, no join)."""
    postings = src_text.parse_postings(I.posting_lines(spark, sf)) if from_text else I.postings(spark, sf)
    return qa.vectors_from_postings(postings, I.LANGS, I.LANG_SPREAD)


def _init_means(spark, sf, vec=None):
    vec = vec if vec is not None else _vectors(spark, sf)
    return smp.initial_means(vec, I.KERNELS, len(I.LANGS), I.SAMPLE_METHOD, I.SAMPLE_SEED)


def _start(spark, sf, from_text: bool = False):
    """Weighted points (held; the caller releases them) and the k starting centres.

    The vectors feed both the initial sample and the weighted points, so they
    are computed once (persisted) and released when both are done.
    """
    vec = _vectors(spark, sf, from_text).persist()
    try:
        means = km.collect_means(_init_means(spark, sf, vec), I.KERNELS)
        pts = km.weighted_points(vec)
        pts.count()
    finally:
        vec.unpersist()
    return pts, means


def _fit(spark, sf, from_text: bool = False):
    """The points and the fit; the points are released (a report computes them again from the postings)."""
    pts, means = _start(spark, sf, from_text)
    try:
        return pts, km.fit(pts, means, I.ETA, I.MAX_ITERATIONS)
    finally:
        release(pts)


@query("posting_parse")
def _posting_parse(spark, sf):
    return src_text.parse_postings(I.posting_lines(spark, sf))


@query("posting_files")
def _posting_files(spark, sf):
    """A1, A3: the posting lines written as text files, a file a partition, and read and parsed again."""
    path = shared_folder(spark, "postings")
    src_text.write_lines(I.posting_lines(spark, sf), path)
    return src_text.parse_postings(src_text.read_lines(spark, path))


@query("word_files")
def _word_files(spark, sf):
    """The distinct words written as a word list, and read again."""
    path = shared_folder(spark, "words")
    src_text.write_lines(I.words(spark, sf).distinct(), path, "word")
    return src_text.read_lines(spark, path).withColumnRenamed("value", "word")


@query("qa_pairs")
def _qa_pairs(spark, sf):
    return qa.qa_pairs(I.postings(spark, sf))


@query("qa_grouped")
def _qa_grouped(spark, sf):
    return qa.qa_grouped(I.postings(spark, sf))


@query("qa_groups")
def _qa_groups(spark, sf):
    """C2 with the pairs, in numbered blocks; a block's answers as text."""
    g = qa.qa_groups(I.hot_postings(spark, sf))
    return g.select("qid", "tags", "block", F.array_join(F.transform("answers", lambda a: F.concat_ws(":", a["idx"], a["id"], a["score"])), ",").alias("answers"))


@query("qa_dropped")
def _qa_dropped(spark, sf):
    """L3: the lenient vectors, how many there are, and what was dropped, by reason, observed in the same run."""
    c = qa.counted_vectors(I.lossy_postings(spark, sf), I.LANGS, I.LANG_SPREAD)
    kept = c.rows.agg(F.count("x").alias("n")).collect()[0]["n"]
    return spark.createDataFrame([("vectors", kept), *c.dropped().items()], "what string, n long")


@query("qa_scored")
def _qa_scored(spark, sf):
    return qa.scored(I.postings(spark, sf), langs=I.LANGS)


@query("vectors")
def _vectors_q(spark, sf):
    return _vectors(spark, sf)


@query("vectors_joined")
def _vectors_joined(spark, sf):
    """B6/B7 from the joined and scored questions (the two-step form of ``vectors``)."""
    return qa.vectors(qa.scored(I.postings(spark, sf), langs=I.LANGS), I.LANGS, I.LANG_SPREAD)


@query("vector_count")
def _vector_count(spark, sf):
    return _vectors(spark, sf).agg(F.count("*").alias("n"))


@query("sample_per_group")
def _sample_per_group(spark, sf):
    return smp.sample_per_group(_vectors(spark, sf), "x", I.KERNELS // len(I.LANGS), I.SAMPLE_SEED, "qid")


@query("sample_global")
def _sample_global(spark, sf):
    return smp.sample_global(_vectors(spark, sf), I.KERNELS, I.SAMPLE_SEED, "qid")


@query("kmeans_init")
def _kmeans_init(spark, sf):
    return _init_means(spark, sf)


@query("kmeans_assign")
def _kmeans_assign(spark, sf):
    vec = _vectors(spark, sf)
    held = vec.persist()
    try:
        means = km.collect_means(_init_means(spark, sf, held), I.KERNELS)
    finally:
        release(held)
    return km.assign(vec, means)


@query("kmeans_assign_table")
def _kmeans_assign_table(spark, sf):
    """C3 with the centres as a table of any length."""
    return nc.assign_table(I.price_points(spark, sf), I.customer_centres(spark, sf))


@query("kmeans_step")
def _kmeans_step(spark, sf):
    pts, means = _start(spark, sf)
    try:
        return km.means_frame(spark, km.step(pts, means))
    finally:
        release(pts)


@query("kmeans_shift")
def _kmeans_shift(spark, sf):
    pts, means = _start(spark, sf)
    old = km.means_frame(spark, means)
    new = km.step_frame(pts, means).select("i", F.col("x").alias("nx"), F.col("y").alias("ny"))
    j = old.join(new, "i", "left").select(
        km.squared_distance(F.col("x"), F.col("y"), F.coalesce("nx", "x"), F.coalesce("ny", "y")).alias("d"))
    return j.agg(F.coalesce(F.sum("d"), F.lit(0.0)).alias("shift"))


@query("kmeans_fit")
def _kmeans_fit(spark, sf):
    _, res = _fit(spark, sf)
    return km.with_state(km.means_frame(spark, res.means), res)


@query("kmeans_trace")
def _kmeans_trace(spark, sf):
    _, res = _fit(spark, sf)
    return km.trace_frame(spark, res)


@query("cluster_report")
def _cluster_report(spark, sf):
    pts, res = _fit(spark, sf)
    return km.with_state(cr.report(pts, res.means, I.LANGS, I.LANG_SPREAD), res)


@query("cluster_report_digits")
def _cluster_report_digits(spark, sf):
    """D16 with D15 by digits."""
    pts, res = _fit(spark, sf)
    return km.with_state(cr.report(pts, res.means, I.LANGS, I.LANG_SPREAD, sel.weighted_median), res)


@query("weighted_median")
def _weighted_median(spark, sf):
    """D15 on groups with as many values as rows: prices in cents by return flag, quantities as weights."""
    li = tbl.table(spark, sf, "lineitem").select("l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"), F.col("l_quantity").cast("long").alias("w"))
    return sel.weighted_median(li, "l_returnflag", "cents")


@query("cluster_report_text")
def _cluster_report_text(spark, sf):
    pts, res = _fit(spark, sf)
    return km.with_state(cr.report_text(cr.report(pts, res.means, I.LANGS, I.LANG_SPREAD)), res)


@query("kmeans_job")
def _kmeans_job(spark, sf):
    """I4: text lines → parse → join/score → vectors → sample → k-means → report."""
    pts, res = _fit(spark, sf, from_text=True)
    return km.with_state(cr.report(pts, res.means, I.LANGS, I.LANG_SPREAD), res)


# ---------------------------------------------------------------- wide survey


def _classified(spark, sf):
    df = I.wide(spark, sf)
    return df, ws.classify_columns(df.columns, I.WIDE_PRIMARY, I.WIDE_WORK, I.WIDE_OTHER)


def _summary(spark, sf):
    df, (p, w, o) = _classified(spark, sf)
    return ws.summary(df, p, w, o)


@query("wide_schema")
def _wide_schema(spark, sf):
    """A5: header → schema (first text, rest double), nullness asserted by a count."""
    df = I.wide(spark, sf)
    schema = src_text.wide_schema(df.columns)
    labels = {f.name: f.dataType.simpleString() for f in schema.fields}
    rep = ws.column_report(df, df.columns, labels)
    return rep.select("pos", "name", F.col("label").alias("type"), "nulls")


@query("wide_files")
def _wide_files(spark, sf):
    """The survey written as CSV files, each with its header, and read again by the header."""
    path = shared_folder(spark, "survey")
    src_text.write_wide_csv(I.wide(spark, sf), path)
    return src_text.read_wide_csv(spark, path)[1]


@query("wide_classify")
def _wide_classify(spark, sf):
    df, (p, w, o) = _classified(spark, sf)
    labels = {**{c: "primary" for c in p}, **{c: "work" for c in w}, **{c: "other" for c in o}}
    names = [c for c in df.columns if c in labels]
    return ws.column_report(df, names, labels).select(
        F.col("name"), F.col("label").alias("grp"), "n_values")


@query("wide_summary")
def _wide_summary(spark, sf):
    return _summary(spark, sf)


@query("wide_typed")
def _wide_typed(spark, sf):
    return ws.typed(_summary(spark, sf))


@query("wide_grouped")
def _wide_grouped(spark, sf):
    return ws.grouped(_summary(spark, sf))


@query("wide_grouped_sql")
def _wide_grouped_sql(spark, sf):
    return ws.grouped_sql(spark, _summary(spark, sf))


@query("wide_grouped_typed")
def _wide_grouped_typed(spark, sf):
    return ws.grouped_typed(ws.typed(_summary(spark, sf)))


# ---------------------------------------------------------------- record sets


def _set(spark, sf, cond=None):
    r = I.records(spark, sf)
    return rs.to_set(r if cond is None else r.filter(cond))


def _rec(df):
    return df.select(*rs.REC)


@query("set_from_list")
def _set_from_list(spark, sf):
    return _rec(_set(spark, sf))


@query("set_union")
def _set_union(spark, sf):
    r = I.records(spark, sf)
    left = rs.members(r.filter(F.col("lang").isin("en", "fr")))
    right = rs.members(r.filter(F.col("lang").isin("fr", "de", "es")))
    return _rec(rs.fetch(rs.union_members(left, right), r))


@query("set_union_all")
def _set_union_all(spark, sf):
    return _rec(rs.union_all(I.records(spark, sf), rs.source_rank("source", I.SOURCES)))


@query("set_size")
def _set_size(spark, sf):
    return rs.size(rs.members(I.records(spark, sf)))


@query("set_filter")
def _set_filter(spark, sf):
    return _rec(rs.filter_set(_set(spark, sf), F.col("retweets") >= 5000))


@query("set_contains")
def _set_contains(spark, sf):
    """Every text of a second table, turns of conversations, probed in the set of all documents."""
    turns = tbl.table(spark, sf, "conversations").select("conv_id", "turn", rs.digest("text").alias("digest"))
    return rs.contains(rs.members(I.records(spark, sf)), turns).select("conv_id", "turn", "contained")


@query("set_remove")
def _set_remove(spark, sf):
    r = I.records(spark, sf)
    return _rec(rs.fetch(rs.remove(rs.members(r), r.filter(F.col("lang") == "de")), r))


@query("set_most")
def _set_most(spark, sf):
    return rs.most_retweeted(_set(spark, sf))


@query("set_desc")
def _set_desc(spark, sf):
    return _rec(rs.descending(_set(spark, sf)))


@query("set_head_tail")
def _set_head_tail(spark, sf):
    return rs.head_flagged(_set(spark, sf))


@query("set_page")
def _set_page(spark, sf):
    """the records of rank 100 to 149 of the descending list."""
    return rl.list_page(_set(spark, sf), 100, 50)


@query("set_render")
def _set_render(spark, sf):
    return rs.render(_set(spark, sf))


@query("topic_filter")
def _topic_filter(spark, sf):
    return _rec(rs.topic(_set(spark, sf), I.TOPIC_A))


@query("topic_table")
def _topic_table(spark, sf):
    """B19 with a topic table: which records have how many keywords of which topic."""
    return pi.topic_matches(_set(spark, sf), I.topics(spark, sf, 5))


@query("topic_table_trending")
def _topic_table_trending(spark, sf):
    """G5 with a topic table."""
    return _rec(pi.trending_topics(_set(spark, sf), I.topics(spark, sf, 12)))


@query("topic_trending")
def _topic_trending(spark, sf):
    return _rec(rs.trending(_set(spark, sf), I.TOPIC_A, I.TOPIC_B))


# ---------------------------------------------------------------- key sets, sums


def _keys_a(spark, sf):
    return ks.keys(tbl.table(spark, sf, "lineitem"), "l_partkey")


def _keys_b(spark, sf):
    return ks.keys(tbl.table(spark, sf, "part"), "p_partkey")


@query("keyset_union")
def _keyset_union(spark, sf):
    return ks.union(ks.key_rows(tbl.table(spark, sf, "lineitem"), "l_partkey"), ks.key_rows(tbl.table(spark, sf, "part"), "p_partkey"))


@query("keyset_intersect")
def _keyset_intersect(spark, sf):
    return ks.intersect(_keys_a(spark, sf), _keys_b(spark, sf))


@query("keyset_diff")
def _keyset_diff(spark, sf):
    return ks.diff(_keys_a(spark, sf), _keys_b(spark, sf))


@query("keyset_filter")
def _keyset_filter(spark, sf):
    return ks.filter_keys(_keys_a(spark, sf), lambda k: k.between(500, 1500))


@query("keyset_map")
def _keyset_map(spark, sf):
    return ks.map_keys(_keys_a(spark, sf), lambda k: F.expr("k div 10"), bound=None)


@query("keyset_forall")
def _keyset_forall(spark, sf):
    return ks.forall(_keys_a(spark, sf), lambda k: k > 0, bound=None)


@query("keyset_exists")
def _keyset_exists(spark, sf):
    return ks.exists(_keys_a(spark, sf), lambda k: k > 1900, bound=None)


@query("keyset_contains")
def _keyset_contains(spark, sf):
    probe = ks.keys(tbl.table(spark, sf, "part"), "p_partkey")
    return ks.contains(_keys_a(spark, sf), probe)


@query("keyset_render")
def _keyset_render(spark, sf):
    return ks.render(_keys_b(spark, sf))


@query("list_sum")
def _list_sum(spark, sf):
    return bs.total(tbl.table(spark, sf, "orders"), "o_custkey")


@query("list_max")
def _list_max(spark, sf):
    return bs.maximum(tbl.table(spark, sf, "orders"), "o_custkey")


# ---------------------------------------------------------------- as SQL text


@query("sql_mentions")
def _sql_mentions(spark, sf):
    """B1, B2, B19, H4 by SQL functions."""
    return fsql.query(spark, "SELECT doc_id, mentions(text, 'the') AS whole, contains_any(text, array('le', 'Le')) AS part FROM {articles}",
                      articles=I.articles(spark, sf))


@query("sql_signature")
def _sql_signature(spark, sf):
    """D20 by SQL functions (word rules on distinct words)."""
    return fsql.query(spark, "SELECT word, signature(word) AS sig FROM (SELECT DISTINCT word FROM {words})", words=I.words(spark, sf))


@query("sql_subtract")
def _sql_subtract(spark, sf):
    """H12 by SQL functions, on part names: the name less its first word."""
    return fsql.query(spark, """SELECT sentence, signature(replace(sentence, ' ', '')) AS x, signature(space_tokens(sentence)[0]) AS y,
        subtract_signature(signature(replace(sentence, ' ', '')), signature(space_tokens(sentence)[0])) AS rest FROM {names}""", names=I.part_names(spark, sf))


@query("sql_balanced")
def _sql_balanced(spark, sf):
    """B23 by SQL functions."""
    return fsql.query(spark, "SELECT doc_id, balanced(text) AS balanced FROM {articles}", articles=I.articles(spark, sf))


@query("sql_keysets")
def _sql_keysets(spark, sf):
    """B21, B22 with the predicate and the function as SQL text."""
    return ks.map_keys(ks.filter_keys(_keys_a(spark, sf), "k BETWEEN 500 AND 1500"), "k DIV 10")


@query("sql_keyset_tests")
def _sql_keyset_tests(spark, sf):
    """D24, D25 with predicates as SQL text."""
    a = _keys_a(spark, sf)
    every = ks.forall(a, "k > 0").select(F.lit("forall").alias("what"), F.col("forall").alias("holds"))
    return every.unionByName(ks.exists(a, "k > 1900").select(F.lit("exists").alias("what"), F.col("exists").alias("holds")))


# ---------------------------------------------------------------- json


@query("json_scan")
def _json_scan(spark, sf):
    ev = tbl.table(spark, sf, "events")
    return ev.select("event_id", sj.json_map("props")["k"].cast("long").alias("k"))


@query("json_records")
def _json_records(spark, sf):
    """A JSON array per record (field ``retweet_count``) read back into records."""
    r = I.records(spark, sf).select("user", F.to_json(F.array(F.struct(
        "text", F.col("retweets").cast("double").alias("retweet_count")))).alias("json"))
    return sj.json_records(r, "json", "user", count_field="retweet_count")


@query("json_write")
def _json_write(spark, sf):
    return sj.records_to_json(I.records(spark, sf), rs.REC)


def _stored(spark, sf):
    """The records written as a store by site: its path and schema."""
    r = I.records(spark, sf).select(*rs.REC, "seq", "source")
    path = shared_folder(spark, "store")
    sj.write_store(r, path)
    return r, path


@query("json_store")
def _json_store(spark, sf):
    """The records as JSON lines by site, and read again."""
    r, path = _stored(spark, sf)
    return sj.read_store(spark, path, r.schema)


@query("json_store_replaced")
def _json_store_replaced(spark, sf):
    """A site's folder replaced, its counts doubled, the others left as they are."""
    r, path = _stored(spark, sf)
    sj.write_store(r.filter(F.col("source") == I.SOURCES[1]).withColumn("retweets", 2 * F.col("retweets")), path, replace_sites=True)
    return sj.read_store(spark, path, r.schema)


@query("json_store_site")
def _json_store_site(spark, sf):
    """A10: one site's records from its folder."""
    r, path = _stored(spark, sf)
    return sj.stored_site(spark, path, r.schema, I.SOURCES[3], I.SOURCES)


@query("json_unparse")
def _json_unparse(spark, sf):
    """A11 in the reference's own record text form."""
    return sj.records_to_lines(I.records(spark, sf))


# ---------------------------------------------------------------- signatures


def _benchmark_words(spark, sf):
    return I.letter_words(tbl.table(spark, sf, "benchmark"))


def _name_words(spark, sf):
    p = tbl.table(spark, sf, "part")
    return p.select(F.explode(F.split("p_name", " ")).alias("word")).filter(F.col("word") != "")


@query("word_signature")
def _word_signature(spark, sf):
    return sg.word_signatures(I.words(spark, sf))


@query("signature_dictionary")
def _signature_dictionary(spark, sf):
    return sg.dictionary(I.words(spark, sf))


@query("word_anagrams")
def _word_anagrams(spark, sf):
    return sg.word_anagrams(_benchmark_words(spark, sf), sg.dictionary(I.words(spark, sf)))


@query("sentence_signature")
def _sentence_signature(spark, sf):
    return sg.sentence_signature(I.sentences(spark, sf))


@query("multiset_subtract")
def _multiset_subtract(spark, sf):
    s = sg.sentence_signature(I.sentences(spark, sf)).withColumnRenamed("sig", "x")
    s = s.withColumn("y", signature(F.get(F.split("sentence", " "), 0)))
    return sg.subtract(s, "x", "y", in_order=True).select("sentence", "x", "y", "rest")


@query("sub_multisets")
def _sub_multisets(spark, sf):
    return sg.combinations(sg.sentence_signature(I.part_names(spark, sf))).select("sentence", "sub")


@query("sentence_anagrams")
def _sentence_anagrams(spark, sf):
    return sg.sentence_anagrams(I.part_names(spark, sf), _name_words(spark, sf))


# ---------------------------------------------------------------- characters


def _docs(spark, sf):
    return tbl.table(spark, sf, "documents")


def _name_codes(spark, sf):
    return cs.code_table(cs.char_freq(tbl.table(spark, sf, "part"), "p_name"))


@query("char_freq")
def _char_freq(spark, sf):
    return cs.char_freq(_docs(spark, sf))


@query("char_freq_ordered")
def _char_freq_ordered(spark, sf):
    return cs.ordered_leaves(cs.char_freq(_docs(spark, sf)))


@query("code_apply")
def _code_apply(spark, sf):
    part = tbl.table(spark, sf, "part")
    return cs.encode(part, "p_name", _name_codes(spark, sf), "p_partkey")


@query("code_merge")
def _code_merge(spark, sf):
    supp = cs.code_table(cs.char_freq(tbl.table(spark, sf, "supplier"), "s_name"))
    return cs.merge_code_tables(_name_codes(spark, sf), supp)


@query("balanced_text")
def _balanced_text(spark, sf):
    return cs.balanced_texts(_docs(spark, sf), "doc_id")
