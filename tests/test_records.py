"""Encoding, scripts, checksums, images, squares, dependencies, graphs and commands against plain Python."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.functions import checksums, markup, vm
from tessera.operators import assets, dependencies, graph, images, lookups, squares, tiles, versions
from tessera.operators.decode import Layout, json_or, schema_violations
from tessera.operators.encode import Encoder, encode
from tessera.operators.vm import Machine, Script
from tessera.sources import schema


def test_encoding_round_trips():
    rng = random.Random(3)
    layout = ["struct", ["$f", "ubyte"], ["a", ["opt", ["$f", 0, "bitflag"], "varuint"]], ["b", ["opt", ["$f", 3, "bitflag"], ["tuple", "utribyte", "paddedstring"]]], ["$n", "varushort"], ["c", ["array", ["ref", "$n"], "varshort"]], ["d", ["buffer", "ubyte", "hex"]], ["e", ["match", "buildnr", {">=700": "varnullint", "other": "byte"}]]]
    for build in (600, 800):
        for _ in range(200):
            v = {"a": rng.choice([None, 0, 32767, 32768, 10**9]), "b": rng.choice([None, {"_0": rng.randrange(2**24), "_1": "é" * rng.randrange(3)}]), "c": [rng.choice([-16384, -65, -64, 0, 63, 64, 16383]) for _ in range(rng.randrange(200))], "d": bytes(rng.randrange(256) for _ in range(rng.randrange(9))).hex(), "e": rng.choice([-1, 0, 5, 127])}
            if build == 600 and v["e"] == 127:
                v["e"] = -128
            data = Encoder(layout).write(v, build)
            assert Layout(layout).read(data, build) == (v, 0, 0)
    codes = {"0x02": {"name": "s", "read": "string"}, "0x01": {"name": "n", "read": "tailed unsigned short"}, "0x07": {"name": "on", "read": "true"}}
    for v in ({}, {"s": "hi", "n": 70000, "on": True}):
        data = Encoder(codes).write(v, 700)
        assert Layout(codes).read(data, 700)[0] == v and data[-1] == 0
    for refused in (["struct", ["$x", "ubyte"], ["y", ["accum", "$x", "ubyte"]]], ["footer", 1, "ubyte"]):
        with pytest.raises(ValueError):
            Encoder(refused)
    with pytest.raises(ValueError):
        Encoder("varushort").write(40000)


def test_encode_frame_json_and_schema(spark):
    out = encode(spark.createDataFrame([(1, 5), (2, 300), (3, None)], "k int, v int"), "v", "ubyte").orderBy("k").collect()
    assert bytes(out[0].data) == b"\5" and out[1].data is None and out[1].error and out[2].data is None and out[2].error is None
    j = spark.createDataFrame([('{"a": 1}',), ("{bad",), (None,)], "t string").select(json_or(F.col("t"), "a int", F.struct(F.lit(-1).alias("a")))["a"].alias("a"))
    assert [r.a for r in j.collect()] == [1, -1, -1]
    assert schema_violations(spark.createDataFrame([], "x int, y string"), schema.TABLES["tiles"])[0] == "y: string and not int"


def test_scripts():
    m = Machine({1: Script([("pushconst", 3, None), ("pushconst", 0, "ab"), ("STRING_LENGTH", 0, None), ("SUB", 0, None), ("CC_CREATE", 4, None), ("CC_SETX", 4, None), ("CC_GETX", 4, None), ("mystery", 0, None), ("return", 0, None)])}, signatures={"mystery": (1, 0, 0, 2, 0, 1)})
    s = m.run(1)
    assert s.ints == [0, 0] and s.texts == [""] and s.components == {4: {"x": 1}}
    e = Machine({1: Script([("pushconst", 7, None), ("pushconst", 2, None), ("enum_getvalue", 0, None), ("pushconst", 5, None), ("pushconst", 9, None), ("struct_getparam", 0, None), ("pushlocalint", 0, None), ("switch", 0, None), ("pushconst", -1, None), ("return", 0, None), ("pushconst", 77, None)], [{1: 2}], (1, 0, 0))}, enums={7: ({2: "two"}, "none")}, params={9: 4}, structs={})
    assert (e.run(1, [1]).ints, e.run(1, [0]).ints, e.run(1, [0]).texts) == ([4, 77], [4, -1], ["two"])
    longs = Machine({1: Script([("pushlong", 2**63, None), ("pushlong", 1, None), ("LONG_ADD", 0, None), ("LONG_UNPACK", 0, None), ("pushconst", -7, None), ("pushconst", 2, None), ("DIV", 0, None)])}).run(1)
    assert longs.ints == [-(2**31), 1, -3]
    with pytest.raises(RuntimeError):
        Machine({1: Script([("jump", -1, None)])}).run(1)


def test_vm_columns(spark):
    r = spark.range(1).select(vm.add(F.lit(2**31 - 1), F.lit(1)).alias("a"), vm.div(F.lit(-7), F.lit(2)).alias("b"), vm.div(F.lit(1), F.lit(0)).alias("c"), vm.length(F.lit("a😀")).alias("d"), vm.to_text(F.lit(-255), 16).alias("e"), vm.long_add(F.lit(2**62), F.lit(2**62)).cast("string").alias("f"), vm.field_values(F.array(F.lit(5), F.lit(6)), F.lit(2)).alias("g")).first()
    assert tuple(r) == (-(2**31), -3, None, 3, "-ff", str(2**63), [6])


def be(*values):
    return b"".join(struct.pack(">i", v) for v in values)


def test_checksums(spark):
    data = bytes(range(60))
    df = spark.createDataFrame([(bytearray(data), zlib.crc32(b"before"))], "d binary, s long")
    r = df.select(checksums.seeded_crc("d", "s").alias("a"), checksums.crc_range(F.col("d"), F.lit(3), F.lit(9)).alias("b"), checksums.strided_crc("d", F.lit(2), F.lit(10), F.lit(3), F.lit(5)).alias("c"), checksums.forged(F.lit(zlib.crc32(data)), F.lit(123456)).alias("e"), *(h.alias(f"m{k}") for k, h in enumerate(checksums.mesh_hashes(F.col("d"))))).first()
    assert (r.a, r.b, r.c) == (zlib.crc32(b"before" + data), zlib.crc32(data[3:9]), zlib.crc32(b"".join(data[2 + 10 * k : 5 + 10 * k] for k in range(5))))
    assert zlib.crc32(data + bytes(r.e)) == 123456 and (r.m0, r.m1) == (zlib.crc32(data[:20]), zlib.crc32(data))
    one = F.lit(1)
    r = spark.range(1).select(checksums.placement_hash(one, F.lit(2), F.lit(-3)).alias("a"), checksums.placement_hash(one, F.lit(2), F.lit(3), F.array(*map(F.lit, (4, 5, 6, 7))), [F.lit(8), *[F.lit(None).cast("int")] * 6]).alias("b"), checksums.height_hash(checksums.placement_bytes(one, one, one), F.array(F.lit(5), F.lit(2)), F.lit(3)).alias("c")).first()
    assert tuple(r) == (zlib.crc32(be(1, 2, -3)), zlib.crc32(be(1, 2, 3, 4, 5, 6, 7, 8, 0, 0, 0, 0, 0, 0)), zlib.crc32(be(1, 1, 1, 2, -1)))
    op = "array<struct<opcode:int,imm:int,ints:array<int>,text:string>>"
    s = spark.createDataFrame([([(1, -2, [9], None), (3, 4, None, "hé")], [[(5, 6)], []])], f"ops {op}, sw array<array<struct<value:int,jump:int>>>")
    got = s.select(checksums.script_hash([F.lit(7)], F.col("ops"), F.col("sw")).alias("h")).first().h
    assert got == zlib.crc32(be(7, 1, -2, 9, 3, 4) + "hé".encode("latin-1") + be(2, 1, 5, 6, 0))
    sq = spark.createDataFrame([(0, 0, 5), (1, 0, 6), (0, 1, 7)], "x int, z int, hash int")
    rects = spark.createDataFrame([("a", 0, 0, 2, 2), ("b", 5, 5, 1, 1)], "id string, x int, z int, xsize int, zsize int")
    assert {r.id: (r.hash, r.exists) for r in checksums.rect_hash(rects, sq).collect()} == {"a": (zlib.crc32(be(5, 6, 7, 0)), True), "b": (zlib.crc32(be(0)), False)}
    t = [(0, 0, 0, True, 0, 3, None, 1, None, 2), (1, 0, 0, True, 1, 4, 5, 0, 1, 2), (1, 1, 0, False, 0, 9, 9, 9, 9, 9), (0, 0, 1, True, 1, 8, None, None, None, None), (2, 0, 0, True, 0, 1, 1, 1, 1, 1)]
    rows = spark.createDataFrame(t, "x int, z int, level int, visible boolean, effective int, height int, overlay int, settings int, shape int, underlay int")
    own = lambda r: zlib.crc32(be(*(-1 if v is None else v for v in r[5:]), r[4]))
    unsigned = lambda *hs: zlib.crc32(b"".join(struct.pack(">I", h) for h in hs)) if hs else 0
    got = {(r.gx, r.gz): r.hashes for r in checksums.floor_groups(rows).collect()}
    a, b, c = own(t[0]), own(t[1]), own(t[3])
    assert got == {(0, 0): [unsigned(a), *[unsigned(a, b, c)] * 3], (1, 0): [unsigned(own(t[4]))] * 4}
    floor = spark.createDataFrame([(1, True, None, 5, [1, 2, 3]), (2, None, 4, None, None)], "id int, bleedToUnderlay boolean, bleedpriority int, material int, color array<int>")
    assert [r.h for r in floor.orderBy("id").select(dependencies.floor_hash(floor).alias("h")).collect()] == [zlib.crc32(be(1, -1, 5, 0x010203, 0xFF00FF, 0xFF00FF, -1)), zlib.crc32(be(0, 4, -1, 0xFF00FF, 0xFF00FF, 0xFF00FF, -1))]


def sprite(pictures, palette, flags):
    """A sprite file of (x, y, rows of palette numbers, rows of alphas)."""
    body = b""
    for _, _, p, a in pictures:
        if p:
            order = (lambda m: [m[y][x] for x in range(len(m[0])) for y in range(len(m))]) if flags & 1 else (lambda m: [v for r in m for v in r])
            body += bytes([flags]) + bytes(order(p)) + (bytes(order(a)) if flags & 2 else b"")
    sizes = [(x, y, len(p[0]) if p else 0, len(p)) for x, y, p, _ in pictures]
    return body + b"".join(bytes(c) for c in palette) + struct.pack(">HHB", 20, 30, len(palette)) + b"".join(struct.pack(f">{len(sizes)}H", *(s[k] for s in sizes)) for k in range(4)) + struct.pack(">H", len(sizes))


def test_images(spark):
    palette, one = [(1, 2, 0), (4, 5, 6)], (3, 4, [[0, 1, 2], [2, 0, 0]], [[9, 8, 7], [6, 5, 4]])
    for flags in range(4):
        (x, y, fw, fh, p), = images.read_sprites(sprite([one, (0, 0, [], [])], palette, flags))
        want = [[(0, 0, 0, 0) if v == 0 else (*palette[v - 1], a if flags & 2 else 255) for v, a in zip(r, s, strict=True)] for r, s in zip(one[2], one[3], strict=True)]
        assert (x, y, fw, fh) == (3, 4, 20, 30) and [[tuple(c) for c in r] for r in p.tolist()] == want
    full = b"\0\0" + struct.pack(">HH", 2, 1) + bytes([1, 2, 3, 4, 5, 6]) + struct.pack(">H", 0x8001)
    assert images.read_sprites(full)[0][4].tolist() == [[[1, 2, 3, 255], [4, 5, 6, 255]]]
    rows = images.sprites(spark.createDataFrame([(1, bytearray(sprite([one, one], palette, 0))), (2, bytearray(b"\0"))], "id long, bytes binary"))
    got = rows.select("id", "sub", "width", "error", images.sprite_hash("pixels").alias("h"), "pixels").orderBy("id", "sub").collect()
    raw = np.frombuffer(bytes(got[0].pixels), np.uint8).reshape(-1, 4).copy()
    raw[raw[:, 2] == 0, 2] = 1
    assert [(r.id, r.sub, r.width) for r in got] == [(1, 0, 3), (1, 1, 3), (2, None, None)] and got[0].h == zlib.crc32(raw.tobytes()) and got[2].error and got[2].h is None
    near = bytearray(bytes(got[0].pixels))
    near[4] += 4
    far = bytearray(near)
    far[4] += 1
    two = spark.createDataFrame([(got[0].pixels, near, far, bytearray(24))], "a binary, b binary, c binary, z binary")
    box = [F.lit(v) for v in (3, 0, 0, 3, 2)]
    r = two.select(images.equal("a", "b", *box).alias("n"), images.equal("a", "c", *box).alias("f"), images.equal("a", "c", F.lit(3), F.lit(2), F.lit(0), F.lit(3), F.lit(2)).alias("part"), images.bounds("a", F.lit(3)).alias("box"), images.bounds("z", F.lit(3)).alias("none"), images.is_empty()("z").alias("e"), images.is_empty("black")("a").alias("b")).first()
    assert (r.n, r.f, r.part, tuple(r.box), tuple(r.none), r.e, r.b) == (True, False, True, (0, 0, 3, 2), (0, 0, 0, 0), True, False)


def test_image_boxes(spark):
    rng = random.Random(1)
    cells = {(x, y) for cx, cy in ((5, 5), (40, 50)) for x in range(cx, cx + 6) for y in range(cy, cy + 6)} | {(rng.randrange(64), rng.randrange(64)) for _ in range(4)}
    got = images.cell_boxes(spark.createDataFrame([("i", *c) for c in sorted(cells)], "image string, cx int, cy int")).collect()
    assert all(any(b.x <= x < b.x + b.w and b.y <= y < b.y + b.h for b in got) for x, y in cells) and len(got) <= 16
    p = spark.createDataFrame([("i", 1, [(0.5, 0.5, 0.0), (0.25, -0.5, 1.0)]), ("i", 2, [(9.0, 9.0, 0.0)])], "image string, id int, points array<struct<x:double,y:double,z:double>>")
    flat = [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 2]]
    assert {r.id: (r.x1, r.y1, r.x2, r.y2, r.inside) for r in images.projected_boxes(p, flat).collect()} == {1: (0.125, -0.25, 0.25, 0.25, True), 2: (4.5, 4.5, 4.5, 4.5, False)}
    z = spark.range(1).select(images.zoom_range(F.lit(512), F.lit(100), F.lit(200), F.lit(64)).alias("z")).first().z
    assert (z.min, z.max, z.base) == (-5, 6.0, 3.0)


def brute_levels(cells):
    """visual level by place, walking up the levels of each place and telling the tiles around."""
    own, out = {}, {}
    for x, z in {(x, z) for x, z, _ in cells}:
        bridge, at = cells.get((x, z, 1), 0) & 2, 0
        for level in range(4):
            if (x, z, level) not in cells:
                continue
            s = cells[x, z, level]
            at = 0 if s & 8 else at
            own[x, z, level] = at
            under = cells.get((x, z, level - 1 if bridge else level))
            if under is not None and under & 4:
                at = (level - 1 if bridge else level) + 1
    for (x, z, level), s in cells.items():
        out[x, z, level] = 0 if s & 8 else max(own.get((x + dx, z + dz, level), 0) for dx in (-1, 0, 1) for dz in (-1, 0, 1))
    return out


def test_shown_levels(spark):
    rng = random.Random(2)
    cells = {(x, z, level): rng.choice([0, 1, 2, 4, 4, 8, 12]) for x in range(6) for z in range(6) for level in range(4) if x != 3 or z != 3}
    got = squares.shown_levels(spark.createDataFrame([(*k, v) for k, v in cells.items()], "x int, z int, level int, settings int")).collect()
    assert {(r.x, r.z, r.level): r.visual for r in got} == brute_levels(cells)


def test_square_helpers(spark):
    c = squares.corners(spark.createDataFrame([(0, 0, 0, 16), (1, 0, 0, 32)], "x int, z int, level int, y int"))
    col = spark.createDataFrame([(0, 0, 0, 0b101, 0b100), (1, 0, 0, 0, 0)], "x int, z int, level int, walk int, sight int")
    assert {(r.x, r.height, r.packed) for r in squares.height_layer(col, c).collect()} == {(0, 1, 1 + 2 * 9), (1, 2, 0)}
    assert squares.any_collision(col.unionAll(col.withColumn("walk", F.lit(2)))).where("x = 0").first().walk == 0b111
    assert squares.area("50.51-52.53") == [(50, 51, 3, 3)] and squares.area("full") == [(0, 0, 100, 200)] and squares.area("mine", {"mine": [(1, 2, 3, 4)]}) == [(1, 2, 3, 4)]
    for bad in ("nothing", " , "):
        with pytest.raises(ValueError):
            squares.area(bad)
    z = squares.zone_areas(spark.createDataFrame([(64, 100, 191, 127)], "xstart int, zstart int, xend int, zend int")).first()
    assert tuple(z) == (1, 1, 3, 2)
    near = squares.padded(spark.createDataFrame([(70, 10)], "x int, z int"))
    assert sorted((r.square_x, r.square_z) for r in near.collect()) == [(0, -1), (0, 0), (1, -1), (1, 0)]
    m = spark.createDataFrame([(0, 0, [(1, 2), (3, 4)]), (5, 5, [(1, 9)]), (50, 5, [(1, 99)])], "x int, z int, materials array<struct<material:int,repeat:int>>")
    assert sorted(map(tuple, squares.material_repeats(m, 0, 0, 10, 10).collect())) == [(1, 9), (3, 4)]
    mesh = spark.createDataFrame([(1, [(0.0, 0.0, 0.0), (3.0, 0.0, 6.0)], [0, 1, 1])], "id int, positions array<struct<x:double,y:double,z:double>>, indices array<int>")
    assert tuple(squares.mesh_centres(mesh).first()) == (1, 2.0, 0.0, 4.0)
    labels = squares.label_uses(spark.createDataFrame([(1, 2, 5, None), (3, 4, None, 5), (9, 9, None, None)], "x int, z int, function int, default_function int"), spark.createDataFrame([(7, 70)], "label int, sprite int"), spark.createDataFrame([(5, 7)], "function int, label int")).first()
    assert (labels.label, labels.sprite, [tuple(u) for u in labels.uses]) == (7, 70, [(1, 2), (3, 4)])
    i = squares.instances(spark.createDataFrame([(1, 1, 0, 0, 0, 0, "b"), (1, 0, 5, 0, 0, 0, "a")], "id int, plane int, x int, z int, rotation int, type int, more string")).first()
    assert [u.more for u in i.instances] == ["a", "b"]
    g = lambda h: spark.createDataFrame([(0, 0, [1, h], 3)], "gx int, gz int, hashes array<long>, dephash long")
    assert squares.floor_changes(g(2), g(5), 1).count() == 1 and squares.floor_changes(g(2), g(5), 0).count() == 0


def test_markup(spark):
    t = spark.createDataFrame([("a<col=ff0000>b & c<br>d",), ("x</col>y<z",), (None,), ("<col=1>a</col></col>b",)], "t string").select(markup.markup_html("t").alias("h")).collect()
    assert [r.h for r in t] == ['a<span style="color:#ff0000;">b &amp; c<br/>d</span>', "y&lt;z", None, "b"]
    r = spark.range(1).select(markup.avatar_bytes(F.lit("*-8=")).alias("a"), markup.between_corners(F.lit(1.25), F.lit(2.5), F.lit(0.0), F.lit(4.0), F.lit(8.0), F.lit(12.0)).alias("h")).first()
    assert bytes(r.a) == b"\xfb\xff" and r.h == 5.0


def test_dependencies(spark):
    npc = spark.createDataFrame([(1, 5, [7, 8], None), (2, 0, None, [8])], "id int, animation_group int, models array<int>, headModels array<int>")
    e = lambda d: sorted(map(tuple, d.collect()))
    assert e(dependencies.npcs(npc)) == [("animgroup-5", "npc-1"), ("model-7", "npc-1"), ("model-8", "npc-1"), ("model-8", "npc-2")]
    group = spark.createDataFrame([(1, 3, (4,)), (2, None, (6,)), (3, None, None)], "id int, unknown_26 int, baseAnims struct<idle:int>")
    assert e(dependencies.animgroups(group)) == [("sequence-3", "animgroup-1"), ("sequence-6", "animgroup-2")]
    mat = spark.createDataFrame([(1, (4, None), 9)], "id int, textures struct<diffuse:int,normal:int>, spriteid int")
    assert [e(dependencies.materials(mat, b)) for b in (300, 470, 600, 800)] == [[("texture-1", "material-1")], [("texture-9", "material-1")], [], [("texture-4", "material-1")]]
    seq = spark.createDataFrame([(1, 2, [(5,), (6,)]), (2, None, [])], "id int, skeletal_animation int, frames array<struct<frameidhi:int>>")
    assert e(dependencies.sequences(seq, 800)) == [("frameset-5", "sequence-1"), ("skeleton-2", "sequence-1")] and e(dependencies.sequences(seq, 400)) == []
    assert e(dependencies.framesets(spark.createDataFrame([(1, 1, 9), (1, 0, 8)], "id int, frame int, probably_framemap_id int"))) == [("framebase-8", "frameset-1")]
    assert e(dependencies.skeletons(spark.createDataFrame([(4, 3)], "id int, framebase int"))) == [("framebase-3", "skeleton-4")] and e(dependencies.overlays(spark.createDataFrame([(1, 0), (2, 3)], "id int, material int"))) == [("material-3", "overlay-2")]
    tree = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d")], "holder string, dep string")
    assert [r.node for r in dependencies.preorder(tree, "a").orderBy("place").collect()] == ["a", "b", "d", "e", "c"]


def test_lookups(spark):
    rows, extra = spark.createDataFrame([(1, 5), (2, 5), (1, 6)], "struct int, param int"), spark.createDataFrame([(1, 5, "x", 1), (1, 5, "y", 0)], "struct int, param int, value string, pos int")
    params = spark.createDataFrame([(5, "d"), (6, None)], "param int, default string")
    assert sorted(map(tuple, lookups.struct_param(rows, extra, params, "").collect())) == [(1, 5, "y"), (1, 6, ""), (2, 5, "d")]
    with pytest.raises(Exception, match="unknown parameter 6"):
        lookups.struct_param(rows, extra, params.where("param = 5"), "").collect()
    cats = spark.createDataFrame([(85, [(1, 0), (2, ord("q")), (3, 0)]), (1, [(4, 0)]), (2, []), (3, [(85, 0)]), (4, None)], "category int, subcategories array<struct<id:int,hotkey:int>>")
    assert sorted((r.category, r.path) for r in lookups.chat_hotkeys(cats).collect()) == [(1, "1"), (2, "q"), (3, "2"), (4, "11"), (85, "")]
    sq = spark.createDataFrame([(1, [(5, [(1, 2, 0, 1, 10), (3, 4, 0, 0, 22)]), (6, [])])], "square int, locations array<struct<id:int,uses:array<struct<x:int,y:int,plane:int,rotation:int,type:int>>>>")
    assert lookups.placements(sq, 5).count() == 2 and lookups.placements(sq, 6).count() == 0
    items = spark.createDataFrame([(1, [(235, 4)]), (2, [(1, 1)]), (3, None)], "id int, extra array<struct<prop:int,intvalue:int>>")
    assert [r.id for r in lookups.with_param(items, 235).collect()] == [1]


def test_versions(spark):
    states = spark.createDataFrame([(1, "me", "running", 1), (2, "you", "running", 1), (3, "you", "running", 30), (4, "me", "done", 50), (5, None, None, 0)], "version int, run string, state string, hours int")
    at = states.selectExpr("*", "timestamp'2024-01-05 00:00:00' now").withColumn("since", F.expr("now - make_interval(0, 0, 0, 0, hours)"))
    assert {r.version: r.go for r in versions.run_gate(at, "me").collect()} == {1: True, 2: False, 3: True, 4: False, 5: True}
    n = spark.range(1).select(versions.history_name(F.lit("new"), F.lit(None).cast("string"), F.lit(3), F.lit(4), F.lit(5), F.lit("src"), F.lit("json")).alias("n"), versions.date_or(F.lit("x"), "1900-01-01").cast("string").alias("d")).first()
    assert tuple(n) == ("new-unknown-3-4-5-src.json", "1900-01-01 00:00:00")
    files = spark.createDataFrame([(1, 1, 1, bytearray(b"xx")), (1, 1, 2, bytearray(b"x"))], "major int, minor int, fileid int, bytes binary")
    assert [r.fileid for r in versions.by_size(files).collect()] == [2, 1]
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 4, "x"), ("b", 3, "y"), ("b", 4, "z")], "f string, v int, h string")
    got = assets.file_history(rows, spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "v int"), "f", "v", "h").orderBy("f", "run").collect()
    assert [(r.f, r.h, r.versions) for r in got] == [("a", "x", [1, 2]), ("a", "x", [4]), ("b", "y", [3]), ("b", "z", [4])]


def test_label_conflicts(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(90, 91)], "src long, dst long")
    nodes = spark.createDataFrame([(k, 7 if k == 33 else None) for k in range(61)] + [(90, 3), (91, 3), (95, None)], "node long, label int")
    got = {r.node: r.label for r in graph.propagate_labels(nodes, edges, "error").collect()}
    assert got == {**dict.fromkeys(range(61), 7), 90: 3, 91: 3, 95: None}
    with pytest.raises(Exception, match="connected nodes are"):
        graph.propagate_labels(nodes.withColumn("label", F.when(F.col("node") == 2, 1).otherwise(F.col("label"))), edges, "error").collect()
    with pytest.raises(Exception, match="door without"):
        areas = spark.createDataFrame([], "kind string, orig_min_x int, orig_max_x int, orig_min_y int, orig_max_y int, dest_min_x int, dest_max_x int, dest_min_y int, dest_max_y int")
        graph.teleport_edges(spark.createDataFrame([(1, 2, None, 4)], "ax int, ay int, bx int, by int"), areas).collect()


def brute_reach(masks, start):
    seen, todo = {s for s in start if s in masks}, [s for s in start if s in masks]
    while todo:
        x, y = todo.pop()
        for b, _, dx, dy, _, _ in tiles.DIRECTIONS:
            t = (x + dx, y + dy)
            if masks[x, y] >> b & 1 and t in masks and t not in seen:
                seen.add(t)
                todo.append(t)
    return seen


def test_reachable_over_many_regions(spark):
    """A winding corridor through many regions, with islands and one-way edges."""
    rng = random.Random(4)
    masks = {}
    for row in range(3):  # corridors of 5 regions, joined at alternating ends
        y = 70 * row
        masks |= {(x, y): 0b0101 for x in range(64 * 5)}
        end = 64 * 5 - 1 if row % 2 == 0 else 0
        masks |= {(end, yy): 0b1010 | 0b0101 * (yy in (y, y + 70)) for yy in range(y, y + 71)} if row < 2 else {}
    masks |= {(rng.randrange(2000, 2200), rng.randrange(200)): rng.randrange(256) for _ in range(8000)}
    rows = spark.createDataFrame([(x, y, 0, m) for (x, y), m in masks.items()], "x int, y int, plane int, walk_mask long")
    start = [(5, 0), (2100, 100), (2150, 20), (9999, 9999)]
    got = {(r.x, r.y) for r in tiles.reachable(rows, spark.createDataFrame([(*s, 0) for s in start], "x int, y int, plane int")).collect()}
    assert got == brute_reach(masks, start) and len(got) > 3 * 320


def test_load_and_clean_commands(spark, tmp_path):
    import json

    for name, rows in (("a", [(0, 0, 255), (1, 0, None), (2, 0, 255)]), ("b", [(1, 0, 255), (70, 0, 255), (71, 0, 255)])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"tiles": [{"x": x, "y": y, "plane": 0, "walkMask": m} for x, y, m in rows]}))
    (tmp_path / "o.txt").write_text("2,0,0,1\n2,0,0,5\n9,9,0,255\n")
    cli.load_tiles(spark, str(tmp_path), f"file://{tmp_path}/tiles", str(tmp_path / "o.txt"))
    got = {(r.x, r.y): (r.walk_mask, r.RegionID) for r in spark.read.parquet(f"file://{tmp_path}/tiles").collect()}
    assert got == {(0, 0): (255, 0), (1, 0): (255, 0), (2, 0): (5, 0), (70, 0): (255, 256), (71, 0): (255, 256), (9, 9): (255, 0)}
    empty = {n: spark.createDataFrame([], s) for n, s in schema.TABLES.items() if n.startswith("teleports_")}
    cli.clean_tiles(spark, f"file://{tmp_path}/tiles", empty, (1, 0, 0), f"file://{tmp_path}/clean")
    assert {(r.x, r.y): r.walk_mask for r in spark.read.parquet(f"file://{tmp_path}/clean").collect()} == {(0, 0): 4, (1, 0): 5, (2, 0): 1}
    lode = spark.createDataFrame([(1, "x", 70, 0, 0, 5, None, None, None)], schema.TABLES["teleports_lodestone_nodes"])
    cli.clean_tiles(spark, f"file://{tmp_path}/tiles", empty | {"teleports_lodestone_nodes": lode}, (1, 0, 0), f"file://{tmp_path}/more")
    assert {(r.x, r.y) for r in spark.read.parquet(f"file://{tmp_path}/more").collect()} == {(0, 0), (1, 0), (2, 0), (70, 0), (71, 0)}
    with pytest.raises(Exception, match="null in dest_x"):
        cli.clean_tiles(spark, f"file://{tmp_path}/tiles", empty | {"teleports_lodestone_nodes": lode.withColumn("dest_x", F.lit(None).cast("int"))}, (1, 0, 0), f"file://{tmp_path}/bad")
    with pytest.raises(NotImplementedError):
        cli.main(["scrapeavatars"])
    with pytest.raises(SystemExit):
        cli.main(["nothing"])
