"""Column functions on hand-made values."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import numeric as N
from tidemark.functions import text as T


def one(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r[1] for r in sorted(df.select("i", column(F.col("v")).alias("r")).collect())]


def plain_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


NUMBERS = ["1", " 2.5 ", "1e3", "abc", "", " ", "nan", "inf", "-Infinity", "1_000", "_1", "1_", "1.0d", "2f", "3D", "0x1p3", None, "+4"]


def test_numbers_parse_as_plain_floats(spark):
    got = one(spark, NUMBERS, N.to_number)
    for text, value in zip(NUMBERS, got):
        if text == "0x1p3":
            continue
        assert str(value) == str(plain_float(text)), text
    assert one(spark, ["x", "7"], N.is_number) == [False, True]


def test_integers(spark):
    assert one(spark, ["120", "120.0", " 7 ", "x"], N.to_integer) == [120, None, 7, None]


def test_ratio_of_zero(spark):
    row = spark.range(1).select(N.ratio(F.lit(1), F.lit(0)), N.ratio(F.lit(1), F.lit(4))).first()
    assert tuple(row) == (None, 0.25)


def test_uniform_is_fixed_and_even(spark):
    df = spark.range(20000).select("id", N.uniform(F.col("id"), seed=3).alias("u"))
    first = df.repartition(7).orderBy("id").collect()
    assert first == df.orderBy("id").collect()
    values = [r.u for r in first]
    assert 0 <= min(values) and max(values) < 1
    assert abs(sum(values) / len(values) - 0.5) < 0.02
    parts = spark.range(3000).select(N.bucket(F.col("id"), buckets=3, seed=1).alias("b")).groupBy("b").count()
    sizes = {r["b"]: r["count"] for r in parts.collect()}
    assert set(sizes) == {1, 2, 3} and min(sizes.values()) > 900


TEXTS = ["The cat, the CAT!", "", None, "a1b2", "  x ", "É école İstanbul", "don't", "tab\tnew\nline"]


def plain_tokens(text):
    return re.sub("[^a-zA-Z]", " ", text or "").lower().split()


def test_tokenize(spark):
    assert one(spark, TEXTS, T.tokenize) == [plain_tokens(t) for t in TEXTS]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), min_size=1, max_size=20))
def test_tokenize_any_text(spark, texts):
    assert one(spark, texts, T.tokenize) == [plain_tokens(t) for t in texts]


def test_stop_words_keep_repeats(spark):
    got = one(spark, ["we like wine wine and you"], lambda c: T.without_stop_words(T.tokenize(c)))
    assert got == [["like", "wine", "wine", "and"]]


def test_single_space_split_counts_empty_tokens(spark):
    assert one(spark, ["a  b "], T.split_on_space) == [["a", "", "b", ""]]


LINES = [
    '<doc id="1" url="u" title="t">Hello, World-wide (web)\xa0a b2b "quoted" éa _x a_ 中文</doc>',
    "no tag at all",
    "<doc>cut short at the end",
    '<doc id="2" url="u"></doc>',
    '<doc id="3" url="u">one > two</doc> tail</doc>',
]


def test_bodies_and_headers(spark):
    """Worked out by hand, in the order of LINES."""
    assert one(spark, LINES, T.body) == [
        '>Hello, World-wide (web)\xa0a b2b "quoted" éa _x a_ 中文',
        "",
        ">cut short at the en",
        ">",
        ">one > two",
    ]
    assert one(spark, LINES, T.header) == ['<doc id="1" url="u" title="t">', "", "<doc>", '<doc id="2" url="u">', '<doc id="3" url="u">']
    assert one(spark, LINES, T.strip_tags) == [
        'Hello, World-wide (web)\xa0a b2b "quoted" éa _x a_ 中文',
        "no tag at all",
        "cut short at the end",
        "",
        "one > two tail",
    ]


def test_corpus_tokens(spark):
    """Blank-separated, edge marks cut, two characters or more."""
    assert one(spark, LINES, T.corpus_tokens) == [
        ["hello", "world-wide", "web", "b2b", '"quoted"', "éa", "_x", "a_", "中文"],
        [],
        ["cut", "short", "at", "the", "en"],
        [],
        ["one", "two"],
    ]


def test_counted_tokens(spark):
    """Space-separated, word-like, punctuation cut, three characters or more; the no-break space does not cut."""
    assert one(spark, LINES, T.counted_tokens) == [
        ["hello", "world-wide", "web)\xa0a", "b2b", "quoted"],
        [],
        ["cut", "short", "the"],
        [],
        ["one", "two"],
    ]


def test_hours_and_quotes(spark):
    assert one(spark, ["2013-01-01 07:15:00", "2013-01-01 23:00:00"], T.hour_of) == ["07", "23"]
    assert one(spark, ['"a"b"'], T.unquote) == ["ab"]


