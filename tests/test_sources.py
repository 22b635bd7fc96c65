import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.plans import quality
from tradewind.sources.duplicates import duplicate_files, empty_files, lines_of, without_duplicate_files
from tradewind.sources.encoding import read_repaired_lines
from tradewind.sources.staging import header_mismatches, parse_lines, read_malformed, read_staging

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def write(path, content):
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_quotes_commas_empty_fields_and_wrong_field_counts(spark, tmp_path, rows):
    path = write(
        tmp_path / "sellers.csv",
        HEADER + 's1,01,"x, ""q"" y",SP\n' + "s2,,rio,RJ\n" + "s3,1,2,3,4\n" + "s4,1,2\n" + 's5,\\N,"",SP\n',
    )
    good = read_staging(spark, path, "sellers")
    assert rows(good) == sorted(
        [("s1", "01", 'x, "q" y', "SP"), ("s2", None, "rio", "RJ"), ("s5", None, "", "SP")],
        key=lambda t: tuple(map(repr, t)),
    )
    # Also when only some columns are asked for.
    assert rows(good, "seller_id") == [("s1",), ("s2",), ("s5",)]
    assert good.count() == 3
    assert rows(read_malformed(spark, path, "sellers"), "line") == [("s3,1,2,3,4",), ("s4,1,2",)]


def test_carriage_return_is_not_part_of_the_last_column(spark, tmp_path, rows):
    path = write(tmp_path / "crlf.csv", HEADER.replace("\n", "\r\n") + "s1,01,rio,RJ\r\n")
    assert rows(read_staging(spark, path, "sellers")) == [("s1", "01", "rio", "RJ")]


def test_line_end_inside_quotes(spark, tmp_path, rows):
    path = write(tmp_path / "multi.csv", HEADER + 's1,01,"two\nlines",SP\ns2,02,one,SP\n')
    got = read_staging(spark, path, "sellers", multi_line=True)
    assert rows(got, "seller_id", "seller_city") == [("s1", "two\nlines"), ("s2", "one")]


def test_lines_that_are_already_a_column(spark, rows):
    lines = spark.createDataFrame([('s1,01,"a, b",SP',), ("s2,1",), ("s3,1,2,3,4",)], "line string")
    good, bad = parse_lines(lines, "line", "sellers")
    assert rows(good) == [("s1", "01", "a, b", "SP")]
    assert bad.count() == 2


def test_encoding_repair(spark, tmp_path, rows):
    content = "são".encode() + b"\n" + "são €".encode("cp1252") + b"\n" + "são".encode("latin-1") + b"\x81\n" + b"plain\n"
    path = write(tmp_path / "mixed.txt", content)
    got = {r.line: r.repaired for r in read_repaired_lines(spark, path).collect()}
    assert got == {"são": False, "são €": True, "são\x81": True, "plain": False}


def test_every_cp1252_character(spark, tmp_path):
    text = "".join(c for b in range(0x80, 0x100) if (c := bytes([b]).decode("cp1252", "ignore")))
    path = write(tmp_path / "all.txt", text.encode("cp1252"))
    assert read_repaired_lines(spark, path).first().line == text


def test_lines_of_a_file_do_not_meet_in_one_task(spark, tmp_path):
    for name, last in (("a", "x"), ("b", "x"), ("c", "y")):
        (tmp_path / f"{name}.txt").write_text("\n".join(f"line {i}" for i in range(20_000)) + f"\n{last}\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        found = duplicate_files(lines_of(spark, str(tmp_path)))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_file" not in plan and "BroadcastHashJoin [_file" in plan
        assert [(r.keep[-5:], r.file[-5:], r.lines) for r in found.collect()] == [("a.txt", "b.txt", 20_001)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_duplicate_files(spark, tmp_path, rows):
    write(tmp_path / "a.csv", "h\n1\n2\n2\n")
    write(tmp_path / "a - Copy.csv", "h\n1\n2\n2\n")
    write(tmp_path / "b.csv", "h\n1\n1\n2\n")
    write(tmp_path / "c.csv", "h\n2\n1\n2\n")
    write(tmp_path / "d.csv", "")
    lines = lines_of(spark, str(tmp_path))
    names = [(r.keep.rsplit("/", 1)[1], r.file.rsplit("/", 1)[1], r.lines) for r in duplicate_files(lines).collect()]
    assert names == [("a%20-%20Copy.csv", "a.csv", 4)]
    assert without_duplicate_files(lines).count() == 12
    assert [r.file.rsplit("/", 1)[1] for r in empty_files(spark, str(tmp_path)).collect()] == ["d.csv"]


def test_order_is_told_over_many_blocks(spark, tmp_path):
    body = [f"line {n}" for n in range(3000)]
    write(tmp_path / "a.csv", "\n".join(body))
    write(tmp_path / "b.csv", "\n".join(body))
    write(tmp_path / "c.csv", "\n".join([*body[:1500], body[1501], body[1500], *body[1502:]]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = [(r.keep[-5:], r.file[-5:], r.lines) for r in duplicate_files(lines_of(spark, str(tmp_path))).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [("a.csv", "b.csv", 3000)]


def test_same_fingerprint_is_compared_line_by_line(spark, monkeypatch):
    """Files that only look alike (equal digests) are not reported."""
    from tradewind.sources import duplicates

    lines = spark.createDataFrame(
        [("f1", 9, "x"), ("f1", 9, "y"), ("f2", 9, "x"), ("f2", 9, "z"), ("f3", 9, "x"), ("f3", 9, "y")],
        "file string, bytes bigint, line string",
    )
    blunt = lambda df: df.groupBy("file").agg(
        F.max("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("lines"),
        *[F.lit(0).alias(c) for c in ("xor_a", "xor_b", "total")],
    )
    monkeypatch.setattr(duplicates, "fingerprints", blunt)
    assert [(r.keep, r.file) for r in duplicate_files(lines).collect()] == [("f1", "f3")]


def test_csv_round_trip(spark, tmp_path):
    from tradewind.sources.tables import write_csv

    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text")])
    original = spark.createDataFrame([("1", 'a, "b"'), ("2", "two\nlines"), ("3", " padded "), ("4", "plain")], schema)
    path = str(tmp_path / "out")
    write_csv(original, path)
    back = read_staging(spark, path, schema, multi_line=True)
    report = {r.check: r.rows_affected for r in quality.csv_quoting(back, original, "text", "id").collect()}
    assert report == {"text with commas, quotes or line ends": 2, "text changed by the round trip": 0}


@pytest.mark.parametrize("table", ["orders", "order_items", "products", "order_payments", "order_reviews", "geolocation"])
def test_raw_schemas_are_text(table):
    from tradewind.schemas import raw_schema

    assert {f.dataType.simpleString() for f in raw_schema(table)} == {"string"}


def test_headers_with_other_names_are_reported(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text")])
    for name, body in {"swapped": "text,id\na,1\n", "windows": "id,text\r\n1,a\r\n", "quoted": '"id","text"\n1,a\n'}.items():
        write(tmp_path / f"{name}.csv", body)
    found = [(r.file[-11:], r.header) for r in header_mismatches(spark, str(tmp_path), schema).collect()]
    assert found == [("swapped.csv", "text,id")]


def test_delivery_holds_every_language(spark):
    from types import SimpleNamespace

    from tradewind.bindings.registered import _file_copies

    docs = spark.createDataFrame([("en", "a"), ("de", "b"), ("it", "c\nd"), (None, "e")], "lang string, text string")
    path = _file_copies(SimpleNamespace(spark=spark, raw=lambda _: docs))
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["a", "a", "b", "c", "d", "e"]
