"""CSV and GeoJSON cut by many tasks: against Spark's whole-file readers and Python's json, at split sizes that cut every record."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from rentalytics.sources import records
from rentalytics.sources.files import read_csv_by_file, read_csv_raw, read_geojson_features, read_optional


@pytest.fixture
def split_size(spark):
    """Set the size of the text source's splits."""
    conf = {"spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"}

    def to(size):
        for k in conf:
            spark.conf.set(k, str(size))
    yield to
    for k in conf:
        spark.conf.unset(k)


def messy(rng):
    return "".join(rng.choice(["a", "b ", '"', '""', ",", "\n", "\r\n", "é", "x,y", "N/A", " 'q' "]) for _ in range(rng.randrange(12)))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size", [128, 1 << 20])
def test_one_file_by_many_tasks(spark, tmp_path, split_size, size):
    rng = random.Random(size)
    rows = [[str(i), messy(rng), messy(rng)] for i in range(30)]
    buffer = io.StringIO()
    csv.writer(buffer, lineterminator="\n").writerows([["id", "text", "more"], *rows])
    path = tmp_path / "one.csv"
    path.write_text(buffer.getvalue(), newline="")
    want = rows_of(read_csv_by_file(spark, str(path)))
    split_size(size)
    got = read_csv_raw(spark, str(path))
    assert rows_of(got) == want and got.columns == ["id", "text", "more"]
    parts = records.pieces(spark, str(path), "\n").select("block").distinct().count()
    assert parts > 4 or size > 1000
    assert records.csv_records(spark, str(path)).count() == 31


def test_quotes_in_bare_fields_and_line_ends(spark, tmp_path, split_size):
    text = 'a,b,c\r\n1,5" pipe,"x, ""y"" \r\nz"\r\n\r\n2,"",\r\n3,it\'s 6"x4,end\r\n4,"""q""","l1\nl2\n\nl4"\r\n'
    path = tmp_path / "q.csv"
    path.write_text(text, newline="")
    want = [("1", '5" pipe', 'x, "y" \r\nz'), ("2", None, None), ("3", 'it\'s 6"x4', "end"), ("4", '"q"', "l1\nl2\n\nl4")]
    split_size(64)
    assert rows_of(read_csv_raw(spark, str(path))) == want


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("y,z\n5,6\n")
    assert rows_of(read_csv_raw(spark, str(tmp_path)).select("x", "y", "z")) == rows_of(
        spark.createDataFrame([("1", "2", None), ("3", "4", None), (None, "5", "6")], "x string, y string, z string"))
    assert rows_of(read_csv_raw(spark, str(tmp_path), ["y", "none"])) == [("2", None), ("4", None), ("5", None)]


def test_broken_records_are_told(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('id,text\n1,fine\n2\n3,too,many\n4,"also\nfine"\n5,"never closed\n6,lost')
    got = {r.id: r.bad for r in read_csv_raw(spark, str(path), corrupt="bad").collect()}
    assert got == {"1": None, "2": "2", "3": "3,too,many", "4": None, "5": '5,"never closed\n6,lost'}


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert read_csv_raw(spark, str(tmp_path / "e.csv"), ["a"]).count() == 0
    (tmp_path / "h.csv").write_text("a,b\n")
    got = read_csv_raw(spark, str(tmp_path / "h.csv"))
    assert got.columns == ["a", "b"] and got.count() == 0


def feature(rng, i):
    odd = rng.choice(["plain", 'a "b" }{][', "back\\slash\\", "brace } in, [text", "é\n"])
    shape = rng.choice([{"type": "Polygon", "coordinates": [[[i, 1.5], [2, 3]], []]}, {"type": "MultiPolygon", "coordinates": [[[[0, i]]]]}, None])
    return {"type": "Feature", "properties": {"neighbourhood": f"{odd}{i}", "neighbourhood_group": rng.choice([None, "g"]), "deep": {"a": [{"b": i}]}}, "geometry": shape}


def document(rng, n):
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": 'x}"['}}, "bbox": [1, [2, 3]], "features": [feature(rng, i) for i in range(n)]}
    if rng.random() < 0.5:
        doc["tail"] = {"note": ["}", {"more": 1}]}
    return doc


@pytest.mark.parametrize("size", [400, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_geojson_by_parts(spark, tmp_path, split_size, size, indent):
    rng = random.Random(size)
    docs = {f"d{k}.geojson": document(rng, n) for k, n in enumerate([0, 1, 12])}
    for name, doc in docs.items():
        (tmp_path / name).write_text(json.dumps(doc, indent=indent, ensure_ascii=False))
    split_size(size)
    got = records.geojson_features(spark, str(tmp_path)).collect()
    want = {(name, i + 1): f for name, doc in docs.items() for i, f in enumerate(doc["features"])}
    assert {(r.file.rsplit("/", 1)[1], r.position): json.loads(r.feature) for r in got} == want and len(got) == len(want)
    read = read_geojson_features(spark, str(tmp_path / "d2.geojson")).select(
        "feature_pos", F.col("feature.properties.neighbourhood").alias("n"), F.variant_get("feature.geometry", "$.type", "string").alias("t")).collect()
    assert sorted((r.feature_pos, r.n, r.t) for r in read) == [
        (i + 1, f["properties"]["neighbourhood"], (f["geometry"] or {}).get("type")) for i, f in enumerate(docs["d2.geojson"]["features"])]


def test_optional_source_that_breaks_while_read(spark, tmp_path):
    good = tmp_path / "good.parquet"
    spark.range(3).write.parquet(str(good))
    assert read_optional(lambda: spark.read.parquet(str(good)), "t").count() == 3
    schema = spark.read.parquet(str(good)).schema
    for f in good.glob("*.parquet"):
        f.write_bytes(b"PAR1 broken")
    assert read_optional(lambda: spark.read.schema(schema).parquet(str(good)), "t") is None
    assert read_optional(lambda: read_csv_raw(spark, str(tmp_path / "none.csv")), "t") is None
    with pytest.raises(Exception):
        read_optional(lambda: spark.range(1).select("absent"), "t")
