"""Survey classification, projection and the three grouped forms."""

import pytest
from conftest import rows

from quarry.operators import wide_summary as ws


def test_classify():
    cols = ["tucaseid", "telfs", "t010101", "t110101", "t180101", "t180301", "t050101", "t180501",
            "t020101", "t180201", "t170101"]
    p, w, o = ws.classify_columns(cols)
    assert p == ["t010101", "t110101", "t180101", "t180301"]
    assert w == ["t050101", "t180501"]
    assert o == ["t020101", "t180201"]


def test_empty_group_raises():
    with pytest.raises(ValueError):
        ws.hours([], "work")


@pytest.fixture(scope="module")
def survey(spark):
    data = [("a", 1.0, 1.0, 15.0, 90.0, 60.0, 30.0),
            ("b", 2.0, 2.0, 22.0, 30.0, 0.0, 60.0),
            ("c", 3.0, 1.0, 23.0, 60.0, 120.0, 0.0),
            ("d", 4.0, 2.0, 55.0, 0.0, 0.0, 0.0),
            ("e", 5.0, 1.0, 30.0, 600.0, 600.0, 600.0),
            ("f", 1.0, 2.0, 22.5, 60.0, 60.0, 60.0),
            ("g", 2.0, 1.0, 14.0, 6.0, 6.0, 6.0)]
    return spark.createDataFrame(data, "tucaseid string, telfs double, tesex double, teage double, "
                                       "t010101 double, t050101 double, t020101 double")


def test_summary_rules(survey):
    s = ws.summary(survey, ["t010101"], ["t050101"], ["t020101"])
    got = {r: None for r in rows(s)}
    assert ("working", "male", "young", 1.5, 1.0, 0.5) in got
    assert ("not working", "male", "active", 1.0, 2.0, 0.0) in got
    assert ("working", "female", "elder", 1.0, 1.0, 1.0) in got      # 22.5 is elder
    assert ("working", "male", "elder", 0.1, 0.1, 0.1) in got        # 14 is elder
    assert len(got) == 6                                              # telfs 5 removed
    assert s.columns == ["working", "sex", "age", "primaryNeeds", "work", "other"]


def test_three_forms_agree_and_sort(spark, survey):
    s = ws.summary(survey, ["t010101"], ["t050101"], ["t020101"])
    a = rows(ws.grouped(s))
    b = rows(ws.grouped_sql(spark, s))
    c = rows(ws.grouped_typed(ws.typed(s)))
    assert a == b == c
    assert [r[:3] for r in a] == sorted(r[:3] for r in a)
    assert ws.grouped_typed(ws.typed(s)).schema == ws.SUMMARY_SCHEMA
