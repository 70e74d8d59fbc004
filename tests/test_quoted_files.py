"""Files whose quoted fields hold line breaks: the same rows as from one task, in many."""

from __future__ import annotations

import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.sources import csv_files, quoted_files

HEADER = ["id", "title", "message"]
LAYOUT = dict(sep=",", quote='"', escape='"')
PLACES = ("at_file", "at_piece", "at_line")


@pytest.fixture
def small_pieces(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def written(path, rows, end="\n"):
    def field(x):
        if x is None:
            return ""
        quoted = any(c in x for c in ',"\n\r') or x == ""
        return '"' + x.replace('"', '""') + '"' if quoted else x

    lines = [",".join(HEADER), *[",".join(map(field, row)) for row in rows]]
    path.write_bytes((end.join(lines) + end).encode())
    return str(path)


def whole(spark, path):
    types = ", ".join(f"{c} string" for c in HEADER)
    return spark.read.schema(types).options(header=True, multiLine=True, **LAYOUT).csv(path)


def quoted(spark, path):
    return quoted_files.read_quoted(spark, path, HEADER, LAYOUT, PLACES)


def bag(df):
    return sorted(map(tuple, df.select(*HEADER).collect()), key=str)


def test_same_rows_as_one_task(spark, small_pieces, tmp_path):
    chance = random.Random(5)
    parts = ["ab", "ç", '"', '""', ",", "\n", "\n\n", " ", "x,y"]

    def text():
        return "".join(chance.choices(parts, k=chance.randrange(9))) or None

    rows = [(str(i), text(), text()) for i in range(400)]
    path = written(tmp_path / "a.csv", rows)
    found = quoted(spark, path)
    assert found.select("at_piece").distinct().count() > 5
    assert bag(found) == bag(whole(spark, path)) == sorted(rows, key=str)


def test_a_record_over_many_pieces(spark, small_pieces, tmp_path):
    long = "\n".join(f'line {i}, "{i}"' for i in range(500))
    rows = [("1", "a", "b"), ("2", long, "c"), ("3", "d", long), ("4", None, "")]
    path = written(tmp_path / "a.csv", rows)
    found = quoted(spark, path)
    assert bag(found) == bag(whole(spark, path))
    assert {r.id: r.title for r in found.collect()}["2"] == long


def test_places_follow_the_order_of_delivery(spark, small_pieces, tmp_path):
    for name in "ab":
        rows = [(f"{name}{i:03}", "two\nlines" if i % 3 else "one", "m") for i in range(150)]
        written(tmp_path / f"{name}.csv", rows)
    found = quoted(spark, str(tmp_path)).orderBy(*PLACES).select("id").collect()
    assert [r.id for r in found] == [f"{n}{i:03}" for n in "ab" for i in range(150)]


def test_line_ends_of_two_bytes_and_a_byte_order_mark(spark, tmp_path):
    path = written(tmp_path / "a.csv", [("1", "a\r\nb", "c"), ("2", "d", "e")], end="\r\n")
    data = (tmp_path / "a.csv").read_bytes()
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + data + b"\r\n\n")
    assert bag(quoted(spark, path)) == [("1", "a\r\nb", "c"), ("2", "d", "e")]


def test_only_a_header_and_no_row(spark, tmp_path):
    path = written(tmp_path / "a.csv", [])
    assert quoted(spark, path).count() == 0


def test_an_unclosed_quote_stops_the_load(spark, tmp_path):
    path = written(tmp_path / "a.csv", [("1", "a", "b")])
    with open(path, "a") as out:
        out.write('2,"open,c\n3,d,e\n')
    with pytest.raises((PySparkException, Py4JJavaError), match="ends inside quotes"):
        quoted(spark, path).collect()


def test_another_header_stops_the_load(spark, tmp_path):
    written(tmp_path / "a.csv", [("1", "a", "b")])
    (tmp_path / "b.csv").write_text("id,message,title\n2,c,d\n")
    with pytest.raises(PySparkException, match="another header"):
        quoted(spark, str(tmp_path)).collect()


def test_reviews_are_read_in_pieces(spark, small_pieces, tmp_path):
    header = csv_files.STAGING["raw_order_reviews"].columns
    message = header.index("review_comment_message")
    lines = [",".join(header)]
    for i in range(200):
        row = [f"r{i}" if c == "review_id" else "" for c in header]
        row[message] = f'"first {i}\nsecond, ""said"""'
        lines.append(",".join(row))
    path = tmp_path / "order_reviews_dataset.csv"
    path.write_text("\n".join(lines) + "\n")
    text = csv_files.with_places(csv_files.read_text(spark, "raw_order_reviews", str(path)))
    assert text.select(csv_files.PLACE[1]).distinct().count() > 5
    typed = csv_files.to_staging(text, "raw_order_reviews")
    assert typed.columns == list(header) and typed.count() == 200
    seventh = typed.where("review_id = 'r7'").first()
    assert seventh.review_comment_message == 'first 7\nsecond, "said"'
    assert typed.where(F.col("review_comment_message").isNull()).count() == 0
