"""Compression, archives, index files, SQLite containers, folders, callbacks."""

import bz2
import lzma
import sqlite3
import struct

import pytest

from tessera import cli
from tessera.functions.hashes import xtea
from tessera.functions.text import legacy_name_hash, name_hash
from tessera.operators import indexes
from tessera.sources import containers as c


def cipher(data, key):
    """XTEA forwards, block by block, in plain Python."""
    ks, out = struct.unpack(">4I", key), b""
    for i in range(0, len(data) // 8 * 8, 8):
        a, b = struct.unpack(">2I", data[i : i + 8])
        s = 0
        for _ in range(32):
            a = a + (((b << 4 ^ b >> 5) + b) ^ (s + ks[s & 3])) & 0xFFFFFFFF
            s = s + 0x9E3779B9 & 0xFFFFFFFF
            b = b + (((a << 4 ^ a >> 5) + a) ^ (s + ks[s >> 11 & 3])) & 0xFFFFFFFF
        out += struct.pack(">2I", a, b)
    return out + data[len(data) // 8 * 8 :]


def test_compression():
    text = b"some text " * 50
    for kind in ("sqlite", "none", "bzip2", "gzip"):
        assert c.decompress(c.compress(text, kind)) == text
    alone = lzma.compress(text, lzma.FORMAT_ALONE)
    blob = b"\3" + (len(alone) - 8).to_bytes(4, "big") + len(text).to_bytes(4, "big") + alone[:5] + alone[13:]
    assert c.decompress(blob) == text
    key = bytes(range(16))
    gz = c.compress(text, "gzip")
    assert xtea(cipher(text, key), key) == text
    assert c.decompress(gz[:5] + cipher(gz[5:], key), key) == text
    for bad in (b"\7abc", gz[:5] + cipher(gz[5:], key)):
        with pytest.raises(ValueError):
            c.decompress(bad)


def test_archives():
    files = [b"one", b"", b"three three", b"4"]
    for split, join in ((c.split_network, c.join_network), (c.split_table, c.join_table)):
        assert [b for _, b in split(join(files), 4)] == files and [b for _, b in split(join(files[:1]), 1)] == files[:1]
    # two chunks: the files' first halves, then their second ones
    assert c.split_network(b"ABC" + b"D" + b"e" + b"f" + struct.pack(">4i", 3, -2, 1, 0) + b"\2", 2) == [(0, b"ABCe"), (3, b"Df")]
    packed = bz2.compress(b"packed " * 9)[4:]
    body = (2).to_bytes(2, "big") + struct.pack(">I", 77) + (5).to_bytes(3, "big") * 2 + struct.pack(">I", 78) + (63).to_bytes(3, "big") + len(packed).to_bytes(3, "big") + b"plain" + packed
    want = [(77, 22, b"plain"), (78, 27, b"packed " * 9)]
    assert c.split_legacy(len(body).to_bytes(3, "big") * 2 + body) == want
    whole = bz2.compress(body)[4:]
    assert c.split_legacy(len(body).to_bytes(3, "big") + len(whole).to_bytes(3, "big") + whole) == want


def index_file(rows, named=False, form=6):
    """An index file of (minor, crc, version, [files]), with names that are their own hashes if asked for."""
    steps = lambda v: b"".join(struct.pack(">H", b - a) for a, b in zip([0, *v], v, strict=False))
    out = bytes([form]) + (struct.pack(">I", 99) if form >= 6 else b"") + bytes([1 if named else 0])
    out += struct.pack(">H", len(rows)) + steps([r[0] for r in rows])
    out += b"".join(struct.pack(">I", 1000 + r[0]) for r in rows) if named else b""
    out += b"".join(struct.pack(">I", r[1]) for r in rows) + b"".join(struct.pack(">I", r[2]) for r in rows)
    out += b"".join(struct.pack(">H", len(r[3])) for r in rows) + b"".join(steps(r[3]) for r in rows)
    return out + (b"".join(struct.pack(">I", 7 * f) for r in rows for f in r[3]) if named else b"")


def test_index_files():
    rows = [(3, 11, 5, [0, 4, 9]), (7, 12, 6, [2])]
    got = c.read_index(index_file(rows, True, 7), 19)
    assert [(r["minor"], r["crc"], r["version"], r["subindices"], r["name"], r["subnames"]) for r in got] == [(3, 11, 5, [0, 4, 9], 1003, [0, 28, 63]), (7, 12, 6, [2], 1007, [14])]
    assert c.read_index(index_file([], False, 5), 1) == [] and c.read_index(index_file(rows), 1)[1]["subnames"] is None
    old = struct.pack(">6I", 5, 1, 0, 0, 9, 2)
    assert [(r["minor"], r["crc"], r["version"]) for r in c.read_root_index(old, 500)] == [(0, 5, 1), (2, 9, 2)]
    new = b"\2" + (struct.pack(">2I", 0, 0) + bytes(8) + bytes(64)) + (struct.pack(">4I", 8, 3, 44, 0) + bytes(64))
    assert [(r["minor"], r["crc"], r["subindexcount"]) for r in c.read_root_index(new, 900)] == [(1, 8, 44)]


@pytest.fixture
def cache(tmp_path):
    """Two SQLite containers: majors 5 and 19."""
    files = {5: {3: [b"a", b"bb"], 130: [b"ccc"]}, 19: {0: [b"item0", b"item1"], 1: [b"item256"]}}
    for major, archives in files.items():
        db = sqlite3.connect(tmp_path / f"js5-{major}.jcache")
        db.execute("CREATE TABLE cache (KEY INTEGER PRIMARY KEY, DATA BLOB, CRC INTEGER)")
        db.execute("CREATE TABLE cache_index (KEY INTEGER, DATA BLOB)")
        db.executemany("INSERT INTO cache VALUES (?, ?, 1)", [(m, c.compress(c.join_table(f))) for m, f in archives.items()])
        db.execute("INSERT INTO cache_index VALUES (1, ?)", [c.compress(index_file([(m, 1, 1, list(range(len(f)))) for m, f in archives.items()]))])
        db.commit()
        db.close()
    return f"file://{tmp_path}"


def test_sqlite_containers(spark, cache, tmp_path):
    files = cli.files_of(spark, f"nxt:{cache}", 900)
    rows = lambda df: sorted((r.major, r.minor, r.fileid, bytes(r.bytes)) for r in df.collect())
    assert rows(files) == [(5, 3, 0, b"a"), (5, 3, 1, b"bb"), (5, 130, 0, b"ccc"), (19, 0, 0, b"item0"), (19, 0, 1, b"item1"), (19, 1, 0, b"item256")]
    assert [(r.major, r.minor) for r in c.root_index(spark, cache).orderBy("minor").collect()] == [(255, 5), (255, 19)]
    assert c.open_source(spark, f"auto:{cache}").count() == 4 and spark.read.format("jcache").option("rowsPerTask", 1).load(cache).count() == 4
    edits = spark.createDataFrame([(19, 0, 1, bytearray(b"new"))], "major int, minor int, fileid int, bytes binary")
    cli.edit(spark, files.select("major", "minor", "fileid", "bytes"), edits, cache)
    assert rows(cli.files_of(spark, cache, 900))[3:5] == [(19, 0, 0, b"item0"), (19, 0, 1, b"new")]
    with pytest.raises(Exception, match="has no file"):
        c.merged_edits(files.select("major", "minor", "fileid", "bytes"), edits.withColumn("fileid", edits.fileid + 5)).collect()
    modes = indexes.Modes.standard(spark, {"items": ["struct", ["text", ["buffer", "bytesleft", "hex"]]]})
    got = {r.id0: r.value.text for r in modes.view("items", cli.files_of(spark, cache, 900), 900, "0-300").collect()}
    assert got == {0: b"item0".hex(), 1: b"new".hex(), 256: b"item256".hex()}
    cli.extract(spark, cli.files_of(spark, cache, 900), "items", modes, f"file://{tmp_path}/out", layout="single", build=900)
    assert spark.read.json(f"file://{tmp_path}/out").count() == 3


def test_bad_blobs_do_not_stop_others(spark):
    blobs = spark.createDataFrame([(1, bytearray(c.compress(b"x"))), (2, bytearray(b"\x09")), (3, None), (4, bytearray())], "k int, data binary")
    got = {r.k: (r.data and bytes(r.data), r.error) for r in c.decompressed(blobs).collect()}
    assert got[1] == (b"x", None) and "unknown" in got[2][1] and got[3] == (None, None) and got[4][1]
    bad = spark.createDataFrame([(5, 1, bytearray(b"\1"), [0, 1], None)], "major int, minor int, data binary, subindices array<int>, subnames array<long>")
    assert c.unpacked(bad, "table").first().error and c.unpacked(bad, "legacy").first().error


def test_names_folders_and_callbacks(spark, tmp_path):
    names = spark.createDataFrame([("m50_50",), ("other",)], "name string")
    of = {r[0]: (r[1], r[2]) for r in names.select("name", name_hash(names.name), legacy_name_hash(names.name)).collect()}
    index = spark.createDataFrame([(5, 9, of["m50_50"][0], [4, 6], [1, of["other"][0]]), (4, 8, of["other"][0], [0], None), (5, 7, of["m50_50"][0], [0], None)], "major int, minor int, name long, subindices array<int>, subnames array<long>")
    assert sorted(map(tuple, c.by_name(index, names).collect())) == [("m50_50", 5, 7), ("other", 4, 8)]
    assert [tuple(r) for r in c.subfile_by_name(index, names).collect()] == [("other", 5, 9, 6)]
    assert sorted(map(tuple, c.any_named(index, names).collect())) == [("m50_50", 5, 7), ("other", 4, 8)]
    for k, n in enumerate(("b.bin", "a.bin", "c.bin")):
        (tmp_path / n).write_bytes(bytes([k]))
    assert sorted((r.minor, bytes(r.data)) for r in c.open_source(spark, f"extracted:file://{tmp_path}", 3).collect()) == [(0, b"\1"), (1, b"\0"), (2, b"\2")]
    got = c.from_callback(spark.createDataFrame([(1, 2, 3), (4, 5, None)], "major int, minor int, crc long"), lambda a, b, crc: b"%d.%d" % (a, b) if crc else None)
    assert sorted((r.major, r.data and bytes(r.data)) for r in got.collect()) == [(1, b"1.2"), (4, None)]
    paths = spark.createDataFrame([("x/maps63.jag",), ("x/maps60.JAG",), ("x/land60.mem",), ("readme",)], "path string")
    assert c.detect(paths) == "classic" and c.detect(paths.limit(0)) == "extracted"
    found = c.classic_versions(paths.selectExpr("lower(path) name"), spark.createDataFrame([(1, "maps", 62), (1, "land", 99), (2, "maps", 70), (2, "land", 59)], "build int, group string, wanted int"))
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "land", 60, True), (1, "maps", 60, True), (2, "land", None, False), (2, "maps", 63, False)]
    with pytest.raises(ValueError):
        c.open_source(spark, "live:")
