"""Page, total and facets of one search, from one reading of its matches."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators.facets import histogram_facet, range_facet, terms_facet
from foliosearch.operators.fulltext import fulltext_query
from foliosearch.operators.summary import HITS, _text_start, count_all, summarise
from foliosearch.plans.search import Search
from foliosearch.plans.term_index import TermIndex
from foliosearch.sources.content import content

FOLDER = "/root/testdata/sf0.001"


def wanted_facets():
    return [terms_facet("state", m.STATE, 3), terms_facet("subject", m.SUBJECTS, 4), histogram_facet("pos", m.POS, 25)]


def rows(df):
    return [tuple(row) for row in df.collect()]


def same_as_apart(search, df, wanted=None):
    """The result against page, total and facets found one by one."""
    wanted = wanted_facets() if wanted is None else wanted
    result = search.result(df, wanted)
    assert rows(result.hits.select(m.UUID)) == rows(search.hits(df).select(m.UUID))
    assert result.total == search.total(df).first()[0]
    assert rows(result.info()) == rows(search.info(df))
    assert sorted(rows(result.facets)) == (sorted(rows(search.facets(df, wanted))) if wanted else [])
    return result


@pytest.mark.parametrize(
    "sort, size, index",
    [
        ([], 5, 3),
        ([(m.TITLE, False), (m.POS, True)], 5, 3),
        ([(m.STATE, False), (m.EXPIRED, True)], 1000, 0),
        ([(m.EXPIRED, True)], 7, 0),
        ([(m.IS_VERSION, False), (m.MODIFIED, True)], 10, 500),
        ([("dc:absent", True), (f"{m.RECORD_VARIABLES}.source", False)], 5, 1),
    ],
)
def test_result_equals_page_total_and_facets(spark, sort, size, index):
    search = Search(p.not_equals(m.PRIMARY_TYPE, "Folder"), principals=["members", "staff"], sort=sort, page_size=size, page_index=index)
    same_as_apart(search, content(spark, FOLDER))


def test_result_without_matches_pages_or_facets(spark):
    df = content(spark, FOLDER)
    none = same_as_apart(Search(p.equals(m.PRIMARY_TYPE, "Nothing"), admin=True, page_size=10), df)
    assert none.total == 0 and none.hits.count() == 0
    same_as_apart(Search(admin=True, page_size=3), df, [])
    everything = Search(admin=True).result(df, wanted_facets())
    assert everything.hits.count() == everything.total == df.count()
    with pytest.raises(ValueError):
        everything.info()
    with pytest.raises(ValueError):
        Search(admin=True, page_size=3).result(df, [terms_facet(HITS, m.STATE)])


def test_facets_are_keyed_by_id(spark):
    result = Search(admin=True, page_size=2).result(content(spark, FOLDER), wanted_facets())
    found = {name: dict(rows(result.facet(name))) for name in ("state", "pos", "other")}
    assert found["other"] == {} and set(found["pos"]) <= {"0", "25", "50", "75"}
    assert sum(found["pos"].values()) == result.total


@pytest.mark.parametrize("ascending", [True, False])
def test_odd_sort_values(spark, ascending):
    """NaN, infinities, nulls, empty and long texts, letters beyond ASCII, a key that repeats."""
    numbers = [math.nan, math.inf, -math.inf, 0.0, -0.0, None, 1e-9, -1e300, 2.5, math.nan]
    texts = ["", None, "a", "a\0", "abcdefgh", "abcdefgi", "é", "日本語", "\x7f", "z" * 5000]
    data = [("r", f"u{k}", numbers[k % 10], texts[(k * 7 + k // 10) % 10]) for k in range(90)]
    data += data[:10]
    random.Random(5).shuffle(data)
    df = spark.createDataFrame(data, f"`{m.REPOSITORY}` string, `{m.UUID}` string, x double, t string")
    for sort in ([("x", ascending)], [("t", ascending)], [("t", ascending), ("x", not ascending)]):
        for size in (3, 40):
            search = Search(admin=True, sort=sort, page_size=size)
            values = [F.col(name) for name in ("x", "t")]
            got, want = (rows(found.select(m.UUID, *values)) for found in (search.result(df).hits, search.hits(df)))
            assert str(got) == str(want)


def test_overlapping_ranges_in_a_result(spark):
    ranges = [("low", None, 60.0), ("high", 40.0, None)]
    same_as_apart(Search(admin=True, sort=[(m.POS, True)], page_size=4), content(spark, FOLDER), [range_facet("pos", m.POS, ranges)])


def test_ranked_result(spark, tmp_path):
    df = content(spark, FOLDER)
    terms = TermIndex(spark, str(tmp_path / "terms"))
    terms.build(df)
    search = Search(fulltext=fulltext_query(spark, "the"), terms=terms, principals=["members"], page_size=9)
    result = same_as_apart(search, df)
    assert result.total > 9


def test_the_bound_reaches_the_scan_and_lets_few_rows_through(spark, tmp_path):
    """A page of 20 out of 20,000 rows: the bound is a plain filter, and some two dozen rows pass."""
    path = str(tmp_path / "rows")
    spark.range(20_000).select(
        F.lit("r").alias(m.REPOSITORY), F.format_string("u%05d", "id").alias(m.UUID),
        F.xxhash64("id").alias("n"), F.timestamp_micros(F.xxhash64("id") % 10**15).alias("at"),
    ).write.parquet(path)
    df = spark.read.parquet(path)
    for sort, filters in (([("n", True)], "LessThanOrEqual(n,"), ([("at", False)], "GreaterThanOrEqual(at,"), ([], "LessThan(`ecm:uuid`,")):
        bound = summarise(df, [], 20, sort).bound
        passed = df.where(bound)
        assert 20 <= passed.count() <= (40 if sort else 1100)
        plan = passed._jdf.queryExecution().executedPlan().toString()
        assert filters.replace("`", "") in plan.replace("`", "")


@pytest.mark.parametrize("sort", [m.POS, m.ISSUED, m.MODIFIED])
def test_one_scan_and_one_grouping_in_hash_tables(spark, sort, tmp_path):
    """Partial counts are all that is shuffled, and nothing is sorted for them."""
    path = str(tmp_path / "rows")
    content(spark, FOLDER).write.parquet(path)
    df = spark.read.parquet(path)
    code = F.unix_micros(sort) if sort == m.MODIFIED else F.unix_date(sort) if sort == m.ISSUED else F.col(sort).cast("long")
    plan = count_all(df, wanted_facets(), 160, code, True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and "ObjectHash" not in plan
    assert "partial_count(1)" in plan and "partial_min" in plan


def test_text_starts():
    assert _text_start(int.from_bytes(b"abc\0\0\0\0", "big")) == "abc"
    assert _text_start(int.from_bytes("aé".encode().ljust(7, b"\0"), "big")) == "a"
    assert _text_start(0) == ""
    assert re.fullmatch("~{7}", _text_start(int.from_bytes(b"~" * 7, "big")))
