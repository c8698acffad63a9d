"""Physical-plan shape checks: the properties the scale design relies on."""

import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as E
from quarry.operators import kmeans as km
from quarry.operators import signatures as sg
from quarry.plans.catalogue import QUERIES
from quarry.session import plan_text

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return plan_text(E.queries()[name](spark, SF), "simple")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_group_sample_deals_a_group_over_salts_first(spark):
    p = plan(spark, "sample_per_group")
    assert re.search(r"Exchange hashpartitioning\(x#\d+, _salt#\d+", p)


def test_plans_inside_the_loops(spark):
    """One k-means step is one aggregate over the points; one anagram step joins on prefixes, by equality."""
    pts = spark.createDataFrame([(0, 1, 1)], "x int, y int, w long")
    p = plan_text(km.step_frame(pts, [(0, 0), (5, 5)]), "simple")
    assert p.count("Exchange") == 1 and "Join" not in p and "SortAggregate" not in p
    sigs = sg.word_signatures(spark.createDataFrame([("abc",), ("bcdefg",)], "word string"))
    rems = spark.createDataFrame([("aabcdefgx",)], "rem string")
    p = plan_text(sg._steps(rems, sg.prefix_tables(sigs, 6)), "simple")
    assert "CartesianProduct" not in p and "NestedLoop" not in p and "Join" in p


def test_no_folder_is_made_and_held_frames_are_released(tmp_path):
    """Without a named checkpoint folder the loops make none (in a session of their own)."""
    code = (
        "import os, sys, tempfile; sys.path.insert(0, %r); d = tempfile.mkdtemp(); tempfile.tempdir = d\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2')"
        ".config('spark.sql.warehouse.dir', d + '/w').getOrCreate()\n"
        "from quarry.plans.catalogue import QUERIES\n"
        "before = set(os.listdir(d)) - {'w'}\n"
        "for q in ('kmeans_fit', 'sentence_anagrams'): QUERIES[q](s, %r).count()\n"
        "made = set(os.listdir(d)) - {'w'} - before\n"
        "assert not {x for x in made if 'quarry' in x}, made\n"
        "assert s.sparkContext.getCheckpointDir() is None\n"
        "held = s.sparkContext._jsc.sc().getPersistentRDDs().size()\n"
        "assert held <= 1, held\n"                      # the anagram result itself
        "print('fine')\n") % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), SF)
    none = tmp_path / "conf"                                # no defaults that name a folder
    none.mkdir()
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=os.environ | {"SPARK_CONF_DIR": str(none)})
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]


@pytest.mark.parametrize("name", ["set_from_list", "set_union", "set_union_all", "cluster_report", "vectors",
                                  "kw_rank"])
def test_hash_aggregation_only(spark, name):
    assert "SortAggregate" not in plan(spark, name)


def test_scan_reads_only_used_columns(spark):
    p = plan(spark, "kw_filter")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
    p = plan(spark, "list_sum")
    assert "ReadSchema: struct<o_custkey:bigint>" in p


def test_keyword_table_is_broadcast_not_the_articles(spark):
    p = plan(spark, "kw_rank_table")
    join = next(line for line in p.splitlines() if "BroadcastHashJoin" in line)
    assert "BuildRight" in join
    built = p[p.index("BroadcastExchange"):]
    assert "inline(" in built and "documents.parquet" not in built
    assert p.index("BroadcastHashJoin") < p.index("partial_count(1)")      # tokens are counted below the join


def test_postings_parsed_once_per_line(spark):
    p = plan(spark, "posting_parse")
    assert p.count("split(") == p.count("FileScan parquet") == 2


def test_filters_reach_the_scan(spark):
    p = plan_text(E.queries()["wide_summary"](spark, SF), "formatted")
    assert "LessThanOrEqual(l_linenumber,4)" in p          # cast on telfs unwrapped and pushed
    p = plan_text(E.queries()["set_remove"](spark, SF), "formatted")
    assert "EqualTo(lang,de)" in p
