"""Files cut by many tasks against Python's own parsers."""

from __future__ import annotations

import csv
import json
import random

import pytest

from regionpulse.sources import readers
from regionpulse.sources import split_files as S


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cell(rng):
    return "".join(rng.choice(['a', 'ñ', '"', ",", "\n", " ", "x", "7"]) for _ in range(rng.randrange(1, 25))) + "z"


def test_csv_splits_equal_a_parser(spark, tmp_path, small_splits):
    rng = random.Random(1)
    want = {}
    for name, columns in (("a_part1", ["title", "url", "rank"]), ("b_part2", ["url", "title", "otro"]), ("c_part3", ["title", "url", "rank"])):
        rows = [[cell(rng), f"{name}-{i}", str(i)] for i in range(200)]
        # One record is longer than several splits.
        rows[50][0] = "line \"q\",\n" * 400 + "end"
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as file:
            file.write("\ufeff" if name == "c_part3" else "")
            out = csv.writer(file, lineterminator="\r\n" if name == "c_part3" else "\n")
            out.writerows([columns, *[r if columns[0] == "title" else [r[1], r[0], r[2]] for r in rows]])
        want |= {r[1]: r[0] for r in rows}
    (tmp_path / "d_part4.csv").write_text("")
    (tmp_path / "other.csv").write_text("url\nno\n")
    assert spark.read.text(str(tmp_path / "a_part1.csv")).rdd.getNumPartitions() > 5
    raw = S.read_split_parts(spark, str(tmp_path))
    rows = raw.collect()
    assert {r.url: r.title for r in rows} == want and len(rows) == len(want)
    assert {r["rank"] for r in rows if r.url.startswith("a_")} == set(range(200)) and {r["rank"] for r in rows if r.url.startswith("b_")} == {None}
    for name in ("a_part1", "c_part3"):
        assert [r.url for r in sorted((r for r in rows if r.url.startswith(name)), key=lambda r: r[readers.SOURCE_ORDER])] == [f"{name}-{i}" for i in range(200)]


def test_odd_csv_lines(spark, tmp_path):
    text = "url,title\nu1,uno,sobra,mas\nu2\n\nu3,nan\nu4,\"open\nu5,x\n"
    (tmp_path / "a_part1.csv").write_text(text)
    assert {(r.url, r.title) for r in S.read_split_parts(spark, str(tmp_path)).collect()} == {("u2", None), ("u3", None), ("u4", "open\nu5,x")}
    with pytest.raises(FileNotFoundError):
        S.read_split_parts(spark, str(tmp_path), "*.none")


def feature(i):
    return {"type": "Feature", "id": f"q{i}", "properties": {"time": 1700000000000 + i, "mag": i / 8, "place": 'at "[x{" \\', "url": None},
            "geometry": {"type": "Point", "coordinates": [i % 9, 1.5, 2.0]}}


def test_geojson_of_all_layouts(spark, tmp_path, small_splits):
    several = {"type": "FeatureCollection", "metadata": {"count": {"n": 3}}, "bbox": [1, [2, 3]], "features": [feature(i) for i in range(100)]}
    (tmp_path / "indented.json").write_text(json.dumps(several, indent=2))
    (tmp_path / "tight.json").write_text(json.dumps({**several, "features": [feature(i) for i in range(100, 160)]}).replace('{"type": "Feature"', '\n{"type": "Feature"'))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(feature(i)) for i in range(160, 200)) + "\n")
    (tmp_path / "collections.json").write_text("\n".join(json.dumps({"features": [feature(i), feature(i + 1)]}) for i in range(200, 240, 2)))
    (tmp_path / "empty.json").write_text("\n")
    rows = S.read_split_geojson(spark, str(tmp_path)).collect()
    assert sorted(r.id_evento for r in rows) == sorted(f"q{i}" for i in range(240))
    assert {r.id_evento: r.magnitud for r in rows} == {f"q{i}": i / 8 for i in range(240)} and {r.lugar for r in rows} == {'at "[x{" \\'}


def test_geojson_that_does_not_parse_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"features": nonsense}\n')
    with pytest.raises(Exception, match="does not parse"):
        S.read_split_geojson(spark, str(tmp_path)).collect()
