"""Hours that fail, and schemas that change: what is loaded, refused and reported."""

import gzip
import json
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.plans import build
from eventloom.sources import hours
from eventloom.sources.merging import SchemaConflict, merged_schema
from eventloom.schemas import flat

DAY = date(2024, 1, 15)


def line(number, hour, login="apache"):
    return json.dumps(
        {"id": str(number), "type": "PushEvent", "actor": {"login": "u"}, "repo": {"name": "apache/x"},
         "payload": {}, "public": True, "created_at": f"2024-01-15T{hour:02d}:10:00Z", "org": {"login": login}}
    )


def write(root, hour, lines, cut=None, day=DAY):
    path = root / str(day) / f"{day}-{hour}.json.gz"
    path.parent.mkdir(parents=True, exist_ok=True)
    content = gzip.compress("\n".join(lines).encode())
    path.write_bytes(content if cut is None else content[:cut])


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    for hour in range(24):
        write(root, hour, [line(100 * hour + n, hour) for n in range(hour % 4 + 1)])
    (root / str(DAY) / f"{DAY}-3.json.gz").unlink()
    many = [line(n, 5, login=f"apache{n}") for n in range(3000)] + [line(5, 5)]
    size = len(gzip.compress("\n".join(many).encode()))
    write(root, 5, many[::-1], cut=size // 2)  # its event stands before the break
    (root / str(DAY) / f"{DAY}-6.json.gz").write_bytes(b"no gzip at all")
    write(root, 7, [])
    write(root, 8, [line(1, 8, login="other"), "", "{broken"])
    return root


def status(df):
    return {r.hour: (r.status, r.event_count) for r in df.collect()}


def test_a_broken_hour_is_left_out_and_reported(spark, tables, raw):
    got = status(hours.load_hours(tables, str(raw), DAY))
    assert {h: got.pop(h)[0] for h in (3, 5, 6, 7, 8)} == {3: "missing", 5: "broken", 6: "broken", 7: "blank", 8: "blank"}
    assert got == {h: ("loaded", h % 4 + 1) for h in got} and len(got) == 19
    loaded = tables.read(build.EVENTS).groupBy(F.hour("ts_utc").alias("hour")).count().collect()
    assert {r.hour: r["count"] for r in loaded} == {h: n for h, (_, n) in got.items()}


def test_loading_again_takes_only_hours_not_loaded(spark, tables, raw):
    hours.load_hours(tables, str(raw), DAY)
    before = tables.read(build.EVENTS).count()
    write(raw, 5, [line(5, 5)])
    write(raw, 4, [line(n, 4) for n in range(50)])  # loaded already: not read again
    got = status(hours.load_hours(tables, str(raw), DAY))
    assert got[5] == ("loaded", 1) and got[4] == ("loaded", 1) and got[6][0] == "broken"
    assert tables.read(build.EVENTS).count() == before + 1
    assert status(tables.read(hours.HOURS)) == got


def test_a_day_without_fault_is_probed_never(spark, tables, raw, monkeypatch):
    for hour in (5, 6):
        write(raw, hour, [line(hour, hour)])
    monkeypatch.setattr(hours, "broken_files", lambda *_: pytest.fail("probed"))
    assert status(hours.load_hours(tables, str(raw), DAY))[6] == ("loaded", 1)


def test_only_failing_days_are_probed_by_hour(spark, raw, monkeypatch):
    other = date(2024, 1, 16)
    for hour in range(3):
        write(raw, hour, ["x"], day=other)
    paths = [f"{raw}/{DAY}/{DAY}-{h}.json.gz" for h in (4, 5, 6)] + [f"{raw}/{other}/{other}-{h}.json.gz" for h in range(3)]
    probed = []
    whole = hours._is_broken
    monkeypatch.setattr(hours, "_is_broken", lambda s, group: probed.append(len(group)) or whole(s, group))
    assert hours.broken_files(spark, paths) == set(paths[1:3])
    assert sorted(probed) == [1, 1, 1, 3, 3]


def test_nothing_loaded_raises(spark, tables, tmp_path):
    write(tmp_path, 0, [line(1, 0, login="other")])
    (tmp_path / str(DAY) / f"{DAY}-1.json.gz").write_bytes(b"no")
    with pytest.raises(hours.NothingLoaded):
        hours.load_hours(tables, str(tmp_path), DAY)
    with pytest.raises(hours.NothingLoaded):
        hours.load_hours(tables, str(tmp_path / "none"), DAY)
    assert not tables.exists(build.EVENTS)


def test_other_errors_are_not_taken_for_broken_files(spark, tables, raw, monkeypatch):
    def fails(*_):
        spark.sql("select no_such_column")

    monkeypatch.setattr(hours, "_staged", fails)
    with pytest.raises(PySparkException):
        hours.load_hours(tables, str(raw), DAY)


# --- schemas ------------------------------------------------------------------------


def rows(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def files(tmp_path):
    return sorted(str(p) for p in tmp_path.rglob("*.parquet"))


def test_columns_are_added_and_widened(spark, tables):
    tables.append("t", rows(spark, "day date, n int, x float", (DAY, 1, 0.5)), ["day"])
    tables.append("t", rows(spark, "day date, N bigint, x double, more string", (DAY, 1 << 40, 0.25, "a")), ["day"])
    tables.append("t", rows(spark, "day date, n smallint", (date(2024, 1, 16), 3)), ["day"])
    got = tables.read("t")
    assert dict(got.dtypes) == {"n": "bigint", "x": "double", "more": "string", "day": "date"}
    assert sorted(got.select("n", "x", "more").collect(), key=lambda r: r.n) == [(1, 0.5, None), (3, None, None), (1 << 40, 0.25, "a")]
    assert tables.read("t", days=["2024-01-16"], day_column="day").first().n == 3


@pytest.mark.parametrize("schema", ["n string", "n boolean", "n double, m string", "n struct<a:int>"])
def test_conflicts_are_refused_before_a_file_is_written(spark, tables, tmp_path, schema):
    tables.append("t", rows(spark, "n bigint, m int", (1, 2)))
    before, known = files(tmp_path), tables.schema("t")
    with pytest.raises(SchemaConflict, match="column n"):
        tables.append("t", spark.createDataFrame([], schema))
    assert files(tmp_path) == before and tables.schema("t") == known
    assert tables.read("t").collect() == [(1, 2)]


def test_nested_fields_are_merged(spark, tables):
    tables.append("t", rows(spark, "s struct<a:int>, l array<struct<x:int>>", ((1,), [(1,)])))
    tables.append("t", rows(spark, "s struct<a:bigint,b:string>, l array<struct<x:int,y:int>>", ((2, "b"), [(1, 2)])))
    got = tables.read("t").selectExpr("s.a", "s.b", "l[0].y as y").collect()
    assert sorted(map(tuple, got)) == [(1, None, None), (2, "b", 2)]
    with pytest.raises(SchemaConflict, match=r"l\.element\.x"):
        tables.append("t", spark.createDataFrame([], "l array<struct<x:string>>"))


def test_replacing_days_and_rebuilding_keep_to_the_schema(spark, tables):
    tables.append("t", rows(spark, "base_date date, n int", (DAY, 1), (date(2024, 1, 16), 2)), ["base_date"])
    tables.replace_days("t", rows(spark, "base_date date, n bigint, k int", (DAY, 5, 6)), [DAY])
    assert sorted(map(tuple, tables.read("t").select("n", "k").collect()), key=repr) == [(2, None), (5, 6)]
    with pytest.raises(SchemaConflict):
        tables.replace_days("t", rows(spark, "base_date date, n string", (DAY, "x")), [DAY])
    tables.rebuild("t", rows(spark, "base_date date, n string", (DAY, "x")), ["base_date"])  # a new version, anew
    assert dict(tables.read("t").dtypes)["n"] == "string"


def test_declared_tables_show_added_columns(spark, tables):
    tables.catalog_prefix = "grown_"
    tables.declare("t", flat("day date, n int"), ["day"])
    tables.append("t", rows(spark, "day date, n bigint, more string", (DAY, 1, "a")), ["day"])
    assert spark.table("grown_t").select("n", "more").collect() == [(1, "a")]
    with pytest.raises(SchemaConflict):
        tables.append("t", rows(spark, "day date, n string", (DAY, "x")), ["day"])
    tables.drop("t")


def test_merging_is_the_same_in_any_order():
    one, two = flat("a int, b date, c float"), flat("a bigint, b timestamp_ntz, c double, d string")
    both, other = merged_schema(one, two), merged_schema(two, one)
    assert {f.name: f.dataType for f in both.fields} == {f.name: f.dataType for f in other.fields}
