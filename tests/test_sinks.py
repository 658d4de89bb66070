import json

from pyspark.sql import functions as F

from tessera.functions import hashes
from tessera.operators import ordered, spatial, trees
from tessera.sources import sinks
from tessera.streaming import tiles as stream

TILES = "x int, y int, plane int, walk_mask long"


def test_walk_files_and_stream(spark, tmp_path):
    walk, out, at = (str(tmp_path / n) for n in ("walk", "out", "at"))
    first = spark.createDataFrame([(1, 2, 0, 3), (70, -1, 1, None)], TILES)
    sinks.write_walk_json(first, walk)
    lines = [json.loads(r.value) for r in spark.read.option("recursiveFileLookup", True).text(walk).collect()]
    assert sorted((c["chunk"]["x"], c["chunk"]["z"], len(c["tiles"])) for c in lines) == [(0, 0, 1), (1, -1, 1)]
    stream.keep_latest(stream.changes(spark, walk), out, at).awaitTermination()
    (tmp_path / "walk" / "later.json").write_text('{"tiles": [{"x": 1, "y": 2, "plane": 0, "walkMask": 9}, {"y": 5, "plane": 0}]}\n')
    stream.keep_latest(stream.changes(spark, walk), out, at).awaitTermination()
    assert sorted(tuple(r) for r in stream.latest(spark, out).collect()) == [(1, 2, 0, 9), (70, -1, 1, None)]


def test_failures_and_listing(spark, tmp_path):
    f = spark.createDataFrame([(4, "t4", [1, 2, 3], 2, "t2", [5, 6, 0], None)], "response_line int, response_ts string, start array<int>, request_line int, request_ts string, request_start array<int>, request_goal array<int>")
    sinks.write_failures(f, str(tmp_path))
    r = spark.read.option("header", True).csv(str(tmp_path / "csv")).first()
    assert (r.start_z, r.request_goal_x, r.response_line) == ("3", None, "4")
    assert spark.read.json(str(tmp_path / "json")).first().start == [1, 2, 3]
    points = spark.createDataFrame([(0, 1, 2, 0), (1, 3, 4, 1)], "n int, x int, y int, plane int")
    assert [r.value for r in sinks.coordinate_lines(points, "head", "};").collect()] == ["head", "    new Coordinate(1, 2, 0),", "    new Coordinate(3, 4, 1)", "};"]
    v = spark.createDataFrame([(1, "a"), (3, "b")], "version int, n string")
    assert [tuple(r) for r in sinks.upsert_versions(v, spark.createDataFrame([(3, "z"), (2, "c")], v.schema)).collect()] == [(3, "b"), (2, "c"), (1, "a")]
    p = spark.createDataFrame([(1, 2, (5).to_bytes(4, "little").hex() * 3), (3, 4, None)], "entrance_from int, entrance_to int, path_blob string")
    assert sorted((r.entrance_from, r.step, r.x) for r in sinks.path_points(p).collect() if r.x) == [(1, 0, 5)] and sinks.path_points(p).count() == 2


def test_extract_layout(spark, tmp_path):
    sinks.write_extract(spark.range(10).select("id", (F.col("id") % 2).alias("archive")).repartition(1), str(tmp_path / "e"), 2)
    assert len(list((tmp_path / "e" / "archive=0").glob("*.json"))) == 3


def test_checksums_and_cipher(spark):
    def plain(data, crc=0):
        for byte in data:
            crc ^= byte << 24
            for _ in range(8):
                crc = ((crc << 1) ^ 0x04C11DB7 if crc >> 31 else crc << 1) & 0xFFFFFFFF
        return crc

    def encrypt(block, key):
        a, b, total = int.from_bytes(block[:4], "big"), int.from_bytes(block[4:], "big"), 0
        k = [int.from_bytes(key[i : i + 4], "big") for i in range(0, 16, 4)]
        for _ in range(32):
            a = (a + ((((b << 4) ^ (b >> 5)) + b) ^ (total + k[total & 3]))) & 0xFFFFFFFF
            total = (total + 0x9E3779B9) & 0xFFFFFFFF
            b = (b + ((((a << 4) ^ (a >> 5)) + a) ^ (total + k[(total >> 11) & 3]))) & 0xFFFFFFFF
        return a.to_bytes(4, "big") + b.to_bytes(4, "big")

    key = bytes(range(1, 17))
    secret = encrypt(b"whatever", key) + encrypt(b"12345678", key) + b"abc"
    rows = spark.createDataFrame([(bytearray(b"123456789"), bytearray(secret), bytearray(key)), (bytearray(), None, bytearray(key))], "d binary, s binary, k binary")
    one, two = rows.select(hashes.forward_crc(F.col("d")), hashes.xtea_decrypt("s", "k")).collect()
    assert one[0] == plain(b"123456789") and bytes(one[1]) == b"whatever12345678abc" and tuple(two) == (0, None)
    assert [r[0] for r in spark.createDataFrame([("0x1F",), ("-0b101",), ("0o17",), ("12",), ("012",), ("x",)], "s string").select(hashes.parse_int(F.col("s"))).collect()] == [31, -5, 15, 12, None, None]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "id long, x int, y int, w int, h int")
    assert spatial.rect_overlap(none, none).count() == 0
    one = spark.createDataFrame([(1, 0, 0, 0, 5)], none.schema)
    assert spatial.rect_overlap(one, one).count() == 0
    assert ordered.running_total(none, ["id"], F.col("x"), "t").count() == 0
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "node string")
    assert [tuple(r) for r in trees.tree_paths(loop, roots).orderBy("depth").collect()] == [("a", 0, "a"), ("b", 1, "a/b")]
