"""Records of CSV files cut in many blocks against Spark's reader, which takes whole files."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources.records import ends_inside, read_records
from tradewind.sources.staging import _parse_records, read_malformed, read_staging

HEADER = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"


@pytest.fixture
def blocks_of(spark):
    """Files are cut into blocks of so many bytes."""
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(x) for x in names]

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], str(size))

    yield set_to
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def whole_files(spark, path, schema):
    """Spark's own reading: a file per task."""
    options = {"header": True, "escape": '"', "nullValue": "\\N", "multiLine": True, "columnPruning": False, "mode": "PERMISSIVE"}
    options |= {"columnNameOfCorruptRecord": "_bad"}
    return spark.read.schema(schema + ", _bad string").options(**options).csv(path)


def test_quoted_line_ends_over_every_border(spark, tmp_path, blocks_of, rows):
    """Four blocks, each border inside a message; one message covers two blocks as a whole."""
    message = "x, \"\"y\"\"\n\n" * 40
    body = [f'r{k},o{k},5,"t",{chr(34)}{k} {message if k != 2 else message * 9}{chr(34)},d,a\n' for k in range(8)]
    path = tmp_path / "reviews.csv"
    path.write_text(HEADER + "".join(body) + "r8,o8,1,,plain,d,a\nr9,too,few\n")
    blocks_of(path.stat().st_size // 4 + 1)
    got = read_staging(spark, str(path), "order_reviews", multi_line=True)
    assert got.rdd.getNumPartitions() > 1
    assert read_records(spark, str(path)).select("record").filter(F.col("record").startswith("r")).count() == 10
    expected = {f"r{k}": f"{k} " + (message if k != 2 else message * 9).replace('""', '"') for k in range(8)} | {"r8": "plain"}
    assert {r["review_id"]: r["review_comment_message"] for r in got.collect()} == expected
    assert rows(read_malformed(spark, str(path), "order_reviews", multi_line=True), "line") == [("r9,too,few",)]


@pytest.mark.parametrize("size", [12, 40, 1 << 20])
def test_random_files_as_whole_files_read(spark, tmp_path, blocks_of, size):
    """Stray quotes, quotes after quotes, empty lines, files that end inside quotes.

    Where a value has quotes that nothing explains, the parser gives the last one back or not by what follows in the file,
    so quotes and closing line ends are not compared; where records end is."""
    rng = random.Random(size)
    parts = ['"', '""', '","', '"\n', ',"', ",", "\n", "a", "é ", "5\" x", '"q"', '"q"z,', "\n\n", '"b\nc"']
    for k in range(30):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        (tmp_path / f"f{k:03d}.csv").write_bytes(("x,y\n" + text + "\n").encode())
    blocks_of(size)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    whole = whole_files(spark, str(tmp_path), "x string, y string")
    want = sorted(whole.select(name.alias("file"), F.translate(F.concat_ws("|", "x", "y", "_bad"), '"\n', "").alias("row")).collect())
    records = read_records(spark, str(tmp_path)).withColumn("file", F.element_at(F.split("file", "/"), -1))
    parsed = _parse_records(records, "record", T.StructType.fromDDL("x string, y string, _malformed string"), "file")
    got = sorted(parsed.select("file", F.translate(F.concat_ws("|", "x", "y", "_malformed"), '"\n', "").alias("row")).collect())
    assert len(got) == len(want) and [x for x in zip(got, want) if x[0] != x[1]] == []


def brute_inside(line, inside):
    """Character by character."""
    state = "quoted" if inside else "start"
    for k, c in enumerate(line):
        if state == "start":
            state = "quoted" if c == '"' else "start" if c == "," else "plain"
        elif state == "quoted" and c == '"':
            state = "closing"
        elif state == "closing":
            state = "quoted" if c == '"' else "start" if c == "," else "plain"
        elif state == "plain" and c == ",":
            state = "start"
    return state == "quoted"


@settings(max_examples=500, deadline=None)
@given(st.text('",ab', max_size=30), st.booleans())
def test_states_of_lines(line, inside):
    assert ends_inside(line, inside) == brute_inside(line, inside)


def test_long_lines():
    assert ends_inside('"' + 'a""' * 1_000_000, False) and not ends_inside('a"' * 1_000_000, False)


def test_lines_are_repaired_before_records_are_cut(spark, tmp_path, blocks_of):
    """One record whose lines are in two encodings."""
    path = tmp_path / "mixed.csv"
    body = "s1,01,".encode() + '"são\n'.encode("cp1252") + "são €\n".encode() + 'preço"'.encode("latin-1") + b",SP\ns2,02,rio,RJ\n"
    path.write_bytes(b"seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + body)
    blocks_of(20)
    got = read_staging(spark, str(path), "sellers", multi_line=True, repair=True)
    assert {r["seller_id"]: r["seller_city"] for r in got.collect()} == {"s1": "são\nsão €\npreço", "s2": "rio"}


def test_empty_files(spark, tmp_path):
    for name, text in (("a", ""), ("b", "x,y\n"), ("c", "x,y"), ("d", "\n\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    assert read_records(spark, str(tmp_path)).count() == 0
