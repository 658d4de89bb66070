"""Jobs over whole tables and from all seeds, against plain Python."""

import random

import pandas as pd

from tessera.functions.masks import DIRECTIONS
from tessera.operators import tiles


def brute_clean(raw, rings, start, ends):
    """Tile -> mask, tile by tile: overrides, reconciled masks, search from all seeds, sanitised masks, overrides again."""
    force, or_ = set(rings), {}
    for x, y in rings:
        for _, _, dx, dy, opp, _ in DIRECTIONS:
            or_[x + dx, y + dy] = or_.get((x + dx, y + dy), 0) | 1 << opp | DIRECTIONS[opp][5]
    put = lambda t, m: 255 if t in force else m | or_.get(t, 0)
    mask = {t: put(t, m or 0) for t, m in raw.items()}

    def ways(t):
        ok = {b: (t[0] + dx, t[1] + dy) for b, _, dx, dy, opp, _ in DIRECTIONS if mask[t] >> b & 1 and mask.get((t[0] + dx, t[1] + dy), 0) >> opp & 1}
        have = sum(1 << b for b in ok)
        return {b: n for b, n in ok.items() if have & DIRECTIONS[b][5] == DIRECTIONS[b][5]}

    todo = [t for t in {start, *ends, *rings} if t in raw]
    seen = set(todo)
    while todo:
        for n in ways(todo.pop()).values():
            if n not in seen:
                seen.add(n), todo.append(n)
    return {t: put(t, sum(1 << b for b, n in ways(t).items() if n in seen)) for t in seen}


def run_clean(spark, raw, rings, start, ends):
    at = lambda rows: spark.createDataFrame([(*t, 0) for t in rows], "x int, y int, plane int")
    t = spark.createDataFrame([(x, y, 0, m, (x >> 6 << 8) + (y >> 6)) for (x, y), m in raw.items()], "x int, y int, plane int, walk_mask long, RegionID int")
    forced = tiles.ring_overrides(at(rings))
    t = tiles.reconcile(tiles.apply_overrides(t, forced))
    reached = tiles.reachable(t, tiles.seeds(at([start]), at(ends), forced))
    return {(r.x, r.y): r.walk_mask for r in tiles.put_back(tiles.sanitise(t, reached), forced).collect()}


def test_clean_from_teleport_ring_and_override(spark):
    # start alone; an island of two behind a teleport; a ring that stands alone and is forced open
    raw = {(0, 0): 0, (10, 10): 4, (11, 10): 1, (20, 20): 0, (30, 30): 4, (31, 30): 1}
    got = run_clean(spark, raw, [(20, 20)], (0, 0), [(10, 10), (99, 99)])
    assert got == brute_clean(raw, [(20, 20)], (0, 0), [(10, 10), (99, 99)]) == {(0, 0): 0, (10, 10): 4, (11, 10): 1, (20, 20): 255}


def test_clean_random(spark):
    rng = random.Random(7)
    raw = {(x, y): rng.choice([None, rng.randrange(256), rng.randrange(256), 255]) for x in range(58, 72) for y in range(60, 70) if rng.random() < 0.8}
    rings, ends = [(60, 61), (61, 61), (70, 69), (90, 90)], [(71, 60), (58, 69), (-4, 3)]
    assert run_clean(spark, raw, rings, (64, 64), ends) == brute_clean(raw, rings, (64, 64), ends)


def test_cleaned_has_forced_masks(spark):
    from tessera.plans import catalog

    assert catalog.queries()["tiles_cleaned"](spark, "/root/testdata/sf0.001").where("x = 3 AND walk_mask = 255").count() >= 1


def test_whole_tables(spark):
    """No row of the small tables is left out of the queries over whole ones."""
    from tessera.plans import catalog

    sf = "/root/testdata/sf0.001"
    run = lambda name: {tuple(r) for r in catalog.queries()[name](spark, sf).collect()}
    part, cust, orders, li = (pd.read_parquet(f"{sf}/{t}.parquet").to_dict("records") for t in ("part", "customer", "orders", "lineitem"))

    b = [(p["p_partkey"], p["p_partkey"] % 500 * 10 + 3, p["p_size"] * 20) for p in part]
    a = [(c["c_custkey"], c["c_custkey"] % 500 * 10, c["c_nationkey"] * 40, 1 + c["c_custkey"] % 37, 1 + c["c_custkey"] % 23) for c in cust]
    assert run("rect_overlap_all") == {(i, j) for i, x, y, w, h in a for j, p, q in b if x < p + 60 and p < x + w and y < q + 40 and q < y + h}
    held = {(o["o_orderkey"], x, y): [j for j, p, q in b if p <= x < p + 60 and q <= y < q + 40] for o in orders for x, y in [(o["o_custkey"] * 7 % 5000, o["o_orderkey"] % 1000)]}
    assert run("first_covering_rect_all") == {(*k, min(v)) for k, v in held.items() if v}

    assert {(x, y) for x, y, f, _ in run("ring_overrides_all") if f == 255} == {(c["c_custkey"] % 500, c["c_nationkey"] * 3) for c in cust}

    last = {}
    for r in sorted((r for r in li if r["l_returnflag"] == "R"), key=lambda r: (r["l_orderkey"], r["l_linenumber"], r["l_partkey"], r["l_suppkey"])):
        last[r["l_partkey"] % 40, r["l_orderkey"] % 40] = r["l_suppkey"] % 256
    before = {(x, y): m for x, y, _, m, _ in run("tiles_load")}
    assert {(x, y): m for x, y, _, m, _ in run("tiles_apply_overrides_all")} == {t: last.get(t, m) for t, m in before.items()}

    root = {}
    for p in part:
        u, v = (root.setdefault(k, k) for k in (p["p_size"], p["p_partkey"] % 53 + 100))
        root = {k: min(u, v) if r in (u, v) else r for k, r in root.items()}
    assert run("label_propagation_all") == set(root.items())
