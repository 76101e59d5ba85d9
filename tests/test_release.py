"""Versions, releases and the stream through broken reads and writes."""

import csv
from pathlib import Path

import pytest

from factloom.operators import release, tables
from factloom.streaming import refresh
from tests import test_survivorship as ts


def test_half_a_version_is_written_again(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_version(spark.range(3), root, "1")
    spark.range(9).write.parquet(f"{root}/version=2")
    Path(f"{root}/version=2/_SUCCESS").unlink()
    assert tables.read_version(spark, root).count() == 3
    tables.write_version(spark.range(5), root, "2")
    assert tables.read_version(spark, root).count() == 5
    # Whole versions are left as they are.
    tables.write_version(spark.range(7), root, "2")
    assert tables.read_version(spark, root).count() == 5


def test_a_release_is_seen_whole_or_not(spark, tmp_path):
    root = str(tmp_path / "r")
    release.load_release(spark, root, "r1", {"dim": spark.range(2), "fact": spark.range(3)})

    class Broken(Exception):
        pass

    class Bad:
        @property
        def write(self):
            raise Broken

    with pytest.raises(Broken):
        release.load_release(spark, root, "r2", {"dim": spark.range(20), "fact": Bad()})
    assert [release.read_release(spark, root, n).count() for n in ("dim", "fact")] == [2, 3]
    release.load_release(spark, root, "r2", {"dim": spark.range(20), "fact": spark.range(30)})
    assert [release.read_release(spark, root, n).count() for n in ("dim", "fact")] == [20, 30]


def test_csv_has_one_header(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x, \"y\"")], "id int, name string"), spark.createDataFrame([(2, None)], "id int, site string")
    release.write_csv(release.with_all_columns(a, b).coalesce(1), str(tmp_path / "all"))
    rows = [list(csv.reader(p.open())) for p in Path(tmp_path / "all").glob("*.csv")]
    assert rows == [[["id", "name", "site"], ["1", "x, \"y\"", ""], ["2", "", ""]]]
    release.write_csv(a.coalesce(1), str(tmp_path / "some"), ["name", "zip"])
    assert [list(csv.reader(p.open()))[0] for p in Path(tmp_path / "some").glob("*.csv")] == [["name", "zip"]]


def test_a_stream_that_cannot_read_its_past_stops_and_loses_nothing(spark, tmp_path):
    rows = ts.facts(7, 200)
    half = len(rows) // 2
    df = lambda part: ts.frame(spark, part).coalesce(1)
    root, source, at = str(tmp_path / "out"), str(tmp_path / "in"), str(tmp_path / "cp")
    step = refresh.refresher(spark, root, ts.RULES, ts.FIELDS)
    df(rows[:half]).write.mode("append").parquet(source)
    refresh.run_available(refresh.fact_stream(spark, source, ts.SCHEMA), step, at)
    first = ts.as_dict(tables.read_version(spark, f"{root}/golden"))
    broken = next(Path(f"{root}/facts").glob("batch=*/*.parquet"))
    held = broken.read_bytes()
    broken.write_bytes(b"not parquet")
    df(rows[half:]).write.mode("append").parquet(source)
    with pytest.raises(Exception):
        refresh.run_available(refresh.fact_stream(spark, source, ts.SCHEMA), step, at)
    assert ts.as_dict(tables.read_version(spark, f"{root}/golden")) == first
    for crc in broken.parent.glob(".*.crc"):
        crc.unlink()
    broken.write_bytes(held)
    refresh.run_available(refresh.fact_stream(spark, source, ts.SCHEMA), step, at)
    assert ts.as_dict(tables.read_version(spark, f"{root}/golden")) == ts.plain_golden(rows)


def test_issued_ids_are_unique_whatever_their_length(spark):
    from factloom.operators import clustering

    rows = spark.range(300).selectExpr("concat('c', id) as cluster", "id as ord")
    registry = rows.where("ord < 5").selectExpr("cluster", "format_string('FL-%05d', ord) as entity_id")
    got = [r["entity_id"] for r in clustering.issue_ids(rows, registry, 99_990).collect()]
    assert len(set(got)) == 300 and {"FL-00004", "FL-99999", "FL-100000", "FL-100284"} <= set(got)
