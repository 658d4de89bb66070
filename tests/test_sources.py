import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions import masks, text
from tessera.operators.indexes import in_ranges
from tessera.operators.search import path_types, search
from tessera.sources import tables


def test_walk_json(spark, tmp_path):
    tile = {"x": 130, "y": -1, "plane": 0, "walkMask": 3, "flag": 1, "walk": {"left": True}}
    (tmp_path / "a.json").write_text(json.dumps({"chunk": {"x": 1, "z": 2, "chunkSize": 64}, "tiles": [tile, {"x": 1, "y": 2, "plane": 1}]}))
    (tmp_path / "b.json").write_text(json.dumps({"tiles": [tile, {"y": 2, "plane": 1}]}))
    (tmp_path / "c.json").write_text("{broken")
    (tmp_path / "d.json").write_text("{}")
    rows = {(r.x, r.y, r.plane): (r.walk_mask, r.RegionID) for r in tables.walk_json(spark, str(tmp_path)).collect()}
    assert rows == {(130, -1, 0): (3, (2 << 8) - 1), (1, 2, 1): (None, 0)}


def test_overrides(spark, tmp_path):
    (tmp_path / "o.txt").write_text("1, 2,0,11\n\n 1,2,0,15\n")
    assert [tuple(r) for r in tables.overrides_text(spark, str(tmp_path / "o.txt")).orderBy("line").collect()] == [(1, 1, 2, 0, 11), (3, 1, 2, 0, 15)]
    (tmp_path / "p.txt").write_text("1,2,0,11\n1,2,3\n")
    with pytest.raises(PySparkException, match="line 2"):
        tables.overrides_text(spark, str(tmp_path / "p.txt")).collect()


def test_coordinates(spark, tmp_path):
    (tmp_path / "c.txt").write_text("1\t2\t0\n\n1 2\n 3 4 1 \n")
    assert [tuple(r) for r in tables.coordinates_text(spark, str(tmp_path / "c.txt")).collect()] == [(1, 2, 0), (3, 4, 1)]


def test_failures_log(spark, tmp_path):
    bad = lambda a: json.dumps({"actions": [{"metadata": {"reason": "start_coordinate_not_found"}, "from": a}, {"metadata": {"reason": "other"}}]})
    lines = [f"[2024-01-01 00:00:00.001] {bad({'max': [1, 2, 3]})}", "[2024-01-01 00:00:01.000] Options(command=python3 start=[X: 5, Y: 6, Z: 0] goal=[X: 7, Y: 8, Z: 1])", f"[2024-01-01 00:00:02.000] start {bad({'max': [1, 2], 'min': [4, 5, 6]})}", "start_coordinate_not_found {broken"]
    (tmp_path / "l.txt").write_text("\n".join(lines))
    rows = [tuple(r)[1:] for r in tables.failures_log(spark, str(tmp_path / "l.txt")).orderBy("response_line").collect()]
    assert rows == [(1, "2024-01-01 00:00:00.001", [1, 2, 3], None, None, None, None), (3, "2024-01-01 00:00:02.000", [4, 5, 6], 2, "2024-01-01 00:00:01.000", [5, 6, 0], [7, 8, 1])]


def test_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(masks.region_id(F.lit(-65), F.lit(130))) == (-2 << 8) + 2
    assert get(masks.centre(F.lit(-3), F.lit(0))) == -1
    assert get(masks.encode_names(F.array(F.lit(" UP "), F.lit(""), F.lit("left")))) == 9
    with pytest.raises(PySparkException, match="unknown direction"):
        get(masks.encode_names(F.array(F.lit("north"))))
    assert get(text.name_hash(F.lit("ab"))) == 97 * 31 + 98
    assert get(text.to_integer(F.lit(" 2.5 "))) == 3 and get(text.to_integer(F.lit("-2.5"))) == -3 and get(text.to_integer(F.lit("x"))) is None
    assert get(text.requirement_list(F.lit("1; 2"))) == "1;2"
    with pytest.raises(PySparkException):
        get(text.requirement_list(F.lit("1;;2")))
    raw = (5).to_bytes(4, "little") + (-2).to_bytes(4, "little", signed=True) + (1).to_bytes(4, "little")
    for form in (f"X'{raw.hex()}'", "\\x" + raw.hex(), raw.hex()):
        assert [tuple(r) for r in get(text.triplets(text.blob_bytes(F.lit(form))))] == [(5, -2, 1)]
    assert get(text.int32(F.lit(2**31).cast("long"))) == -(2**31)
    assert get(text.low_name(F.lit("Big Fish+x"))) == "big_fish_x"


def test_search(spark):
    rows = spark.createDataFrame([(1, [{"name": "Oak Tree", "n": [1, 2]}]), (2, None), (3, [{"name": None, "n": [5]}])], "id int, uses array<struct<name:string,n:array<int>>>")
    ids = lambda *f: [r.id for r in search(rows, list(f)).orderBy("id").collect()]
    assert ids((["uses", "name"], "oak")) == [1] and ids((["uses", "n"], 5)) == [3] and ids((["uses", "n"], "5")) == [] and ids((["no"], 1)) == []
    assert [r.id for r in rows.where(in_ranges([F.col("id")], "1,3-")).orderBy("id").collect()] == [1, 3]


def test_ranges_bound_only_their_ends(spark):
    """Every id against plain tuples, in ranges whose second part is smaller at the end than at the start."""
    ids = [(a, b, c) for a in range(1, 3) for b in range(4, 9) for c in range(4)]
    rows = spark.createDataFrame(ids, "a int, b int, c int")
    for t, lo, hi in (("1.5.2-1.7.1", (1, 5, 2), (1, 7, 1)), ("1.6-2.5.0", (1, 6, 0), (2, 5, 0)), ("2.5", (2, 5, 0), (2, 5, 99)), ("1.7.3-", (1, 7, 3), (9,)), ("-1.4.2", (0,), (1, 4, 2))):
        got = sorted(map(tuple, rows.where(in_ranges([F.col(x) for x in "abc"], t)).collect()))
        assert got == [i for i in ids if lo <= i <= hi], t
    assert path_types(spark.createDataFrame([], "a struct<b: array<struct<c: int, d: string, e: struct<f: boolean>>>>").schema, ["a", "b"]) == ["c:number", "d:string", "e:object"]


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    """Files read in many small blocks: numbers by file, requests carried over block borders and not over files."""
    request = "[2024-01-02 03:04:05.678] Options(command=python3 start=[X: {0}, Y: 2, Z: 0])"
    failure = 'x start_coordinate_not_found {"actions": [{"metadata": {"reason": "start_coordinate_not_found"}, "from": {"max": [1, 2, 3]}}]}'
    one = [request.format(7)] + ["noise " * 5] * 400 + [failure] + ["more noise"] * 300 + [request.format(8), failure]
    (tmp_path / "a.log").write_text("\n".join(one) + "\n")
    (tmp_path / "b.log").write_text("\n".join(["first"] * 3 + [failure]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = tables.numbered_lines(spark, str(tmp_path / "a.log")).orderBy("line").collect()
        found = tables.failures_log(spark, f"{tmp_path}/*.log").orderBy("file", "response_line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.line, r.value) for r in lines] == list(enumerate(one, 1)) and len({r.block for r in lines}) > 5
    assert [(r.response_line, r.request_line, r.request_start) for r in found] == [(402, 1, [7, 2, 0]), (704, 703, [8, 2, 0]), (4, None, None)]
