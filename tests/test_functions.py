"""Column functions on hand-made values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom.functions import dates, keys, numeric, rules, text


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def each(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn("v").alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [
        ("https://www.a.com/b/c?d=1", "www.a.com", "b/c"),
        ("http://a.com:8080/x", "a.com:8080", "x"),
        ("android-app://m.a.com/x", "m.a.com", "/m.a.com/x"),
        ("a.com?x=1", "a.com", ""),
        ("a.com", "a.com", "a.com"),
        ("https://a.com/", "a.com", ""),
        ("a.com/p#frag?q", "a.com", "p#frag"),
        (None, None, None),
    ],
)
def test_url_host_and_path(spark, url, host, path):
    assert each(spark, [url], "string", text.url_host) == [host]
    assert each(spark, [url], "string", text.url_path) == [path]


def test_url_parameter_is_a_plain_text_match(spark):
    urls = ["a.com?utm_source=x&b=2", "a.com?utm_source=", "a.com?max=7", "a.com", None]
    assert each(spark, urls, "string", lambda c: text.url_parameter(c, "utm_source")) == ["x", None, None, None, None]
    assert each(spark, urls, "string", lambda c: text.url_parameter(c, "x"))[2] == "7"


def test_slugify(spark):
    values = ["", None, "!Hell0 world-hi", "0Hell0 world-hi", "a  - b", "É x"]
    expected = ["", "", "hell0_world_hi", "_0hell0_world_hi", "a_b", "_x"]
    assert each(spark, values, "string", text.slugify) == expected
    assert [text.slug(v or "") for v in values] == expected


def test_surrogate_key_marks_nulls(spark):
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    got = one(
        spark,
        a=keys.surrogate_key([F.lit(1), F.lit(None).cast("string"), F.lit(True)]),
        b=keys.surrogate_key([F.lit("x"), F.lit(None).cast("int")], nulls_as_empty=True),
        c=keys.surrogate_key([F.lit("x")]),
        d=keys.hash_key(F.lit(None).cast("string")),
        e=keys.namespaced("p-", F.lit(None).cast("string")),
        f=keys.member(F.lit(None).cast("string")),
    )
    assert got == {
        "a": md5(f"1-{keys.NULL_MARK}-true"),
        "b": md5("x-"),
        "c": md5("x"),
        "d": None,
        "e": None,
        "f": "Unknown",
    }


def test_safe_math(spark):
    null = F.lit(None).cast("int")
    got = one(
        spark,
        add=numeric.safe_add([F.lit(1), null, F.lit(3)]),
        sub=numeric.safe_subtract([F.lit(10), F.lit(3), null, F.lit(2)]),
        none=numeric.safe_add([null]),
        div=numeric.safe_divide(F.lit(6), F.lit(4)),
        zero=numeric.safe_divide(F.lit(6), F.lit(0)),
        expr=numeric.safe_divide(F.lit(6) + F.lit(2), F.lit(2) - F.lit(2)),
    )
    assert got == {"add": 4, "sub": 5, "none": 0, "div": 1.5, "zero": None, "expr": None}
    for fn in (numeric.safe_add, numeric.safe_subtract):
        with pytest.raises(TypeError):
            fn("a")


def test_width_bucket_follows_its_contract(spark):
    got = each(spark, [5.3, 10.6, 0.1, 99.0, 0.2, None], "double", lambda c: numeric.width_bucket(c, 0.2, 10.6, 5))
    assert got == [3, 6, 0, 6, 1, None]


def test_haversine(spark):
    # Berlin to Paris.
    points = [F.lit(x) for x in (52.52, 13.405, 48.8566, 2.3522)]
    got = one(spark, mi=F.round(numeric.haversine(*points), 0), km=F.round(numeric.haversine(*points, unit="km"), 0))
    assert got == {"mi": 546.0, "km": 878.0}
    with pytest.raises(ValueError, match="unit"):
        numeric.haversine(*points, unit="m")


@pytest.mark.parametrize(
    ("low", "high", "mid"), [(10.0, 20.0, 15.0), (10.0, 0.0, 10.0), (None, 20.0, 20.0), (-1.0, None, None)]
)
def test_pay_rule(spark, low, high, mid):
    lo, hi = (numeric.positive(F.lit(v).cast("double")) for v in (low, high))
    assert one(spark, mid=numeric.midpoint(lo, hi))["mid"] == mid


def test_calendar_parts_in_both_conventions(spark):
    day = F.lit(date(2021, 1, 3))  # a Sunday in ISO week 53 of 2020
    plain = spark.range(1).select(*dates.calendar_parts(day)).first().asDict()
    assert plain == {
        "date_key": 20210103,
        "full_date": date(2021, 1, 3),
        "year": 2021,
        "quarter": 1,
        "month": 1,
        "month_name": "Jan",
        "week_of_year": 53,
        "day_of_week": 0,
        "day_name": "Sun",
        "is_weekend": True,
    }
    assert spark.range(1).select(*dates.calendar_parts(day, iso=True)).first().day_of_week == 7


def test_dates(spark):
    got = one(
        spark,
        bad=dates.parse_timestamp(F.lit("soon")),
        good=dates.parse_timestamp(F.lit("2026-06-01T00:00:11+02:00")),
        seven=dates.parse_timestamp(F.lit("2026-05-01T00:00:00.1234567")),
        key=dates.date_key(F.lit(None).cast("timestamp")),
        added=dates.add_units(F.lit(datetime(2026, 1, 31)).cast("timestamp_ntz"), "month", 1),
        passed=dates.units_between("month", F.lit(date(2026, 1, 31)), F.lit(date(2026, 2, 1))),
    )
    assert got["bad"] is None and got["key"] is None
    assert got["good"] == datetime(2026, 5, 31, 22, 0, 11)
    assert got["seven"] == datetime(2026, 5, 1, 0, 0, 0, 123456)
    assert got["added"] == datetime(2026, 2, 28)
    assert got["passed"] == 1


@pytest.mark.parametrize(
    ("title", "family", "level", "kind"),
    [
        ("Machine Learning Data Engineer", "ML Engineer", "Mid", "Full-time"),
        ("Data Engineer", "Data Engineer", "Mid", "Full-time"),
        ("Data Science Lead", "Data Scientist", "Lead/Principal", "Full-time"),
        ("Sr. Analytics Partner", "Data Analyst", "Senior", "Full-time"),
        ("AI Engineer, entry", "AI Engineer", "Junior", "Full-time"),
        ("Developer (contract)", "Software Engineer", "Mid", "Contract"),
        ("Infrastructure Associate, Part Time", "DevOps / Platform", "Junior", "Part-time"),
        ("Product Owner", "Product", "Mid", "Full-time"),
        ("Internal Auditor", "Other", "Intern", "Internship"),
        ("Senior Lead Cook", "Other", "Lead/Principal", "Full-time"),
    ],
)
def test_rules_in_order(spark, title, family, level, kind):
    got = one(
        spark,
        family=rules.classify_by_keyword(F.lit(title), rules.ROLE_FAMILIES, rules.ROLE_FAMILY_DEFAULT),
        level=rules.classify_by_keyword(F.lit(title), rules.SENIORITY_LEVELS, rules.SENIORITY_DEFAULT),
        kind=rules.classify_by_keyword(F.lit(title), rules.EMPLOYMENT_TYPES, rules.EMPLOYMENT_DEFAULT),
    )
    assert got == {"family": family, "level": level, "kind": kind}


def test_value_rules(spark):
    got = each(
        spark,
        ["aws", "sql", "spark", "redis", "cooking", None],
        "string",
        lambda c: rules.classify_by_value(c, rules.SKILL_CATEGORIES, rules.SKILL_CATEGORY_DEFAULT),
    )
    assert got == ["cloud", "language", "framework", "database", "other", "other"]


def test_terms_match_inside_words(spark):
    got = each(spark, ["JavaScript on MongoDB", "Power BI", "nothing here", None], "string", rules.tag_terms)
    assert got == [["java", "javascript", "go", "mongodb"], ["power bi"], [], []]


def test_terms_as_whole_words(spark):
    texts = ["JavaScript on MongoDB", "java, JavaScript; C++/Go", "Power BI", "power, bi-weekly", "empowerbi power  bi!", "", None, "go", "é-learning nlp2 C++11 (c++)"]
    got = each(spark, texts, "string", lambda c: rules.tag_terms(c, whole_word=True))
    assert got == [["javascript", "mongodb"], ["java", "javascript", "go", "c++"], ["power bi"], ["power bi"], ["power bi"], [], [], ["go"], ["c++"]]
    own = ["b", "A b", "--", "c# ", "a  B", "c"]
    got = each(spark, ["a b", "b a", "c#", "c # a, b"], "string", lambda c: rules.tag_terms(c, own, whole_word=True))
    assert got == [["b", "A b", "a  B"], ["b"], ["c# "], ["b", "A b", "a  B", "c"]]
    assert each(spark, ["a b"], "string", lambda c: rules.tag_terms(c, ["--"], whole_word=True)) == [[]]


def test_mentions(spark):
    df = spark.createDataFrame([("Fully REMOTE", None), (None, "telework ok"), (None, None)], "a string, b string")
    got = [tuple(r) for r in df.select(text.mentions(["a", "b"], "remote"), text.mentions(["a", "b"], "remote|telework")).collect()]
    assert got == [(True, True), (False, True), (False, False)]
