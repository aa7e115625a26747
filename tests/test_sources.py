"""Readers, parsers and writers on hand-made files."""

import bz2
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import trips as trip
from tidemark.sources import readers, writers


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def fields(**changes):
    row = ["t", "d", "2013-01-01 10:00:00", "", "600", "2.5", "", "", "", "", "", "9.0", "0.5", "", "", "4.0", "12.5"]
    for at, value in changes.items():
        row[int(at[1:])] = value
    return row


TRIPS = {
    "good": fields(),
    "short": fields()[:16],
    "long": fields() + ["x"],
    "word distance": fields(f5="abc"),
    "blank distance": fields(f5=""),
    "nan distance": fields(f5="nan"),
    "decimal duration": fields(f4="120.0"),
    "zero duration": fields(f4="0"),
    "zero surcharge": fields(f12="0"),
    "zero amount": fields(f16="0.0"),
    "low bounds": fields(f4="120", f5="1", f11="3", f15="3"),
    "high bounds": fields(f4="3600", f5="50", f11="200", f15="3"),
    "low tolls": fields(f15="2.99"),
    "nan tolls": fields(f15="nan"),
    "long ride": fields(f4="3601"),
}


def kept(spark, keep):
    rows = [",".join([name] + row[1:]) for name, row in TRIPS.items()]
    return {r.taxi for r in keep(readers.parse_trips(lines(spark, rows))).select("taxi").collect()}


def test_trip_filters(spark):
    everything = set(TRIPS)
    basic = everything - {"short", "long", "word distance", "blank distance"}
    assert kept(spark, trip.basic_trips) == basic
    paid = basic - {"zero duration", "zero amount"}
    assert kept(spark, trip.paid_trips) == paid
    assert kept(spark, trip.surcharged_trips) == paid - {"zero surcharge"}
    assert kept(spark, trip.regular_trips) == {"good", "low bounds", "high bounds", "zero surcharge", "zero amount"}


def test_split_runs_once_per_line(spark):
    plan = trip.regular_trips(readers.parse_trips(lines(spark, ["a,b"])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_compressed_text(spark, tmp_path):
    path = tmp_path / "trips.csv.bz2"
    path.write_bytes(bz2.compress("\n".join(",".join(r) for r in [fields(), fields(f0="u")]).encode()))
    assert {r.taxi for r in readers.read_trips(spark, str(path)).collect()} == {"t", "u"}


def test_tagged_documents(spark):
    rows = [
        '<doc id="AU1" url="http://x" title="T">Some text here</doc>',
        '<doc id="7" url="u">quote "> inside</doc>',
        '<doc id="8" url="u">abc',
        "not a document",
        '<doc id="9">no link</doc>',
    ]
    got = {r.doc_id: r.text for r in readers.parse_documents(lines(spark, rows)).collect()}
    assert got == {"AU1": "Some text here", "7": 'quote "> inside', "8": ""}


def test_links(spark, tmp_path):
    text = '"1","Sports"\n"1","Cities, old"\n"2","He said ""x"""\n'
    (tmp_path / "links.csv").write_text(text)
    got = {tuple(r) for r in readers.read_links(spark, str(tmp_path / "links.csv")).collect()}
    assert got == {("1", "Sports"), ("1", "Cities, old"), ("2", 'He said "x"')}
    plain = {tuple(r) for r in readers.parse_links(lines(spark, text.splitlines()[:2])).collect()}
    assert plain == {("1", "Sports"), ("1", "Cities")}


def test_reviews(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        ',country,description,designation,points,price,region_1,variety\n'
        '0,x,"dry, ""big""\nwine",d,88,1,r,Merlot\n'
    )
    row = readers.read_reviews(spark, str(tmp_path / "r.csv"), multi_line=True).first()
    assert row.asDict() == {
        "_c0": "0", "description": 'dry, "big"\nwine', "designation": "d", "points": "88", "region_1": "r", "variety": "Merlot",
    }


def test_clusters_round_trip(spark, tmp_path):
    rows = [(3, '<doc id="20_newsgroups/sci.med/12345" url="" title="t">'), (18, '<doc id="20_newsgroups/comp.graphics/37261" url="">')]
    path = str(tmp_path / "clusters")
    writers.write_clusters(spark.createDataFrame(rows, "cluster INT, header STRING"), path)
    got = [tuple(r) for r in readers.read_clusters(spark, path).collect()]
    assert sorted(got) == [("18", "comp.graphics"), ("3", "sci.med")]


def test_writers(spark, tmp_path):
    df = spark.range(100).repartition(5)
    writers.write_report(df, str(tmp_path / "one"))
    assert len([n for n in os.listdir(tmp_path / "one") if n.startswith("part")]) == 1
    writers.write_table(df, str(tmp_path / "many"))
    assert spark.read.parquet(str(tmp_path / "many")).count() == 100
    writers.write_lines(df.withColumn("b", F.lit("x")), str(tmp_path / "text"))
    assert readers.read_lines(spark, str(tmp_path / "text")).filter("value = '7,x'").count() == 1


def test_report_has_a_bound(spark, tmp_path):
    writers.write_report(spark.range(7).repartition(3), str(tmp_path / "fits"), most=7)
    with pytest.raises(Exception, match="at most 6 rows"):
        writers.write_report(spark.range(7).repartition(3), str(tmp_path / "long"), most=6)


HEADER = "_c0,country,description,designation,points,price,region_1,variety"


def review_text(draw, n):
    """Records whose quoted text holds line breaks, doubled quotes, commas, blanks; some over many ranges."""
    parts = ["word", '""', "\n", ",", "é", " ", "\n\n", '"",""', "日本", ""]
    rows = []
    for i in range(n):
        text = "".join(draw.choices(parts, k=900 if i in (5, 6) else draw.randint(0, 30)))
        name = draw.choice(["plain", '"two\nlines"', "", '""', '"a ""b"""'])
        rows.append(f'{i},x,"{text}",{name},{draw.choice(["88", "", "n/a"])},1,r,{draw.choice(["Merlot", ""])}')
        rows += [""] * draw.choice([0, 0, 0, 1, 2])
    return "\n".join([HEADER, *rows]) + draw.choice(["", "\n"])


@pytest.mark.parametrize("size", [300, 1 << 27])
def test_reviews_with_line_breaks_are_split(spark, tmp_path, size):
    """Each file is read in many ranges, and gives the rows of a reader that takes it whole."""
    draw = random.Random(size)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(review_text(draw, 30))
    (tmp_path / "3.csv").write_text(HEADER + "\n")
    (tmp_path / "4.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = readers.read_reviews(spark, str(tmp_path), multi_line=True)
        got = [tuple(r) for r in rows.collect()]
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert tasks > 30 if size == 300 else tasks >= 1
    reader = spark.read.options(header=True, multiLine=True, escape='"', lineSep="\n").csv([str(tmp_path / f"{i}.csv") for i in range(3)])
    want = [tuple(r) for r in reader.select(*readers.REVIEW_COLUMNS).collect()]
    key = lambda r: [str(v) for v in r]
    assert len(got) == 90 and sorted(got, key=key) == sorted(want, key=key)


def test_record_starts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h,i\n1,"a\n\nb"\n\n2,c\r\n"3\n')
    rows = readers.csv_records(spark, str(tmp_path / "a.csv")).collect()
    assert sorted((r.first, r.record) for r in rows) == [(False, '"3'), (False, '1,"a\n\nb"'), (False, "2,c\r"), (True, "h,i")]
