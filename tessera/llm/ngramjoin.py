"""Near-duplicate documents: an exact Jaccard self-join on word shingles with several global token orders.

A document's set is its distinct runs of ``SIZE`` words. Two sets of Jaccard similarity t or more share ceil(t n) tokens of either's
n. So, whatever global order the tokens are put in, they share one of the first n - ceil(t n) + 1 (the prefix).

1. Equal sets are one class (by a 128-bit signature); what follows holds for one document of each.
2. How many sets hold a token: tokens are dealt, packed, into buckets by their value, and each bucket is sorted in memory.
   Only documents of which at least ceil(t n) tokens are held by others go on - the prefix filter under any order
   that puts single tokens first. That is done for all documents, then again among those left. Hot tokens, which a
   hundred-thousandth of all places hold (so there can't be more than a hundred thousand), are found by batch-wise counts,
   sent to all tasks, and never dealt: they come last in every order.
3. Three orders, all by rising number of holders, with ties (and near ties) broken by three different hashes. Pairs must share a
   prefix token in each of them, and sizes within t; then tokens are counted.
4. Pairs are not listed inside large groups: of each prefix token, all holders are first compared with two of them. What
   that links becomes one component. Then holders of different components are compared, block by block: only pairs of blocks
   are listed, and inside one a pair that is joined by links found there is passed over. Components are exact.
   Joins in which a token, a hub or a component may hold any share of the rows are salted (``spread_join``).
5. Components by alternating large and small stars, with tables in the shared folder between rounds.

Defined results: null or empty text, or text without words, has an empty set and is its own component; fewer than SIZE words are one
token; of rows with one doc_id each is a document of its own, and the component is the least doc_id reached, null only where no
other is; ids that are null stay null; other columns are never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm.common import BLOCK, boxed, cut, documents, forget, mix, number, pieces, shingle_hashes, spread_join, trim, unboxed, word_hashes, word_spans

SIZE, THRESHOLD = 5, Fraction(3, 4)
BUCKET_TOKENS = 1_000_000
HOT_TOKENS = 100_000
PART_DOCS = 40_000
BLOCK_DOCS = 128


def token_sets(column, limit: int = BLOCK):
    """Row number and sorted distinct tokens of each text."""
    for i, _, buf, offs in pieces(column, limit):
        starts, ends, first = word_spans(buf, offs)
        s, at = shingle_hashes(word_hashes(buf, starts, ends, lower=True), first, SIZE)
        for k in range(len(offs) - 1):
            yield i + k, np.unique(s[at[k] : at[k + 1]])


def need(n, t: Fraction = THRESHOLD):
    """ceil(t n)"""
    return -(-t.numerator * n // t.denominator)


# -- packed inverted index ----------------------------------------------------------------------------


@dataclass
class Hot:
    """Tokens that very many documents hold, sorted, and about how many (never less than two)."""

    tokens: np.ndarray
    held: np.ndarray

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Place of each token among the hot ones, -1 for none."""
        if not len(self.tokens):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, at, -1)


def repeated(sets: list[np.ndarray]) -> bytes:
    """Tokens that two or more of the sets hold, and how many do, packed."""
    tokens, held = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
    return np.stack([tokens[held > 1], held[held > 1].astype(np.uint64)]).tobytes()


def hot_tokens(signed: DataFrame, places: int, most: int = HOT_TOKENS) -> Hot:
    """The tokens whose counts in the batches add up to a most-th of all places, and to a thousand."""

    def unpack(batches):
        for b in batches:
            both = [np.frombuffer(v.as_py(), np.uint64).reshape(2, -1) for v in b.column("repeated")]
            tokens, held = (np.concatenate([np.zeros(0, np.uint64), *(x[k] for x in both)]).view(np.int64) for k in (0, 1))
            for i in range(0, max(1, len(tokens)), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(tokens[i : i + 100_000]), pa.array(held[i : i + 100_000])], ["token", "held"])

    counts = signed.where("repeated IS NOT NULL").select("repeated").mapInArrow(unpack, "token long, held long").groupBy("token").agg(F.sum("held").alias("held"))
    rows = counts.where(F.col("held") >= max(common.HOT_ROWS, places // most)).collect()  # at most `most` rows
    tokens = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return Hot(tokens[order], np.array([r["held"] for r in rows], np.int64)[order])


class _Dealer:
    """Collects (document, set) and gives packed rows for each bucket of token values.

    Hot tokens go into buckets -1 - part instead, part being that of the document: docs and sizes for each of them, and as
    owners how many hold it.
    """

    names = ["bucket", "docs", "sizes", "tokens", "owners"]
    fields = "bucket int, docs binary, sizes binary, tokens binary, owners binary"

    def __init__(self, buckets: int, parts: int, hot: Hot, most: int = 400_000):
        self.buckets, self.parts, self.hot, self.most = buckets, parts, hot, most
        self.reset()

    def reset(self):
        self.docs, self.sets, self.n = [], [], 0

    def add(self, doc: int, tokens: np.ndarray):
        self.docs.append(doc), self.sets.append(tokens)
        self.n += len(tokens)

    def flush(self) -> pa.RecordBatch:
        docs, n = np.array(self.docs, np.int64), np.array([len(s) for s in self.sets], np.int64)
        tokens = np.concatenate([np.zeros(0, np.uint64), *self.sets])
        owner = np.repeat(np.arange(len(docs)), n)
        at = self.hot.find(tokens)
        rows = []
        if (at >= 0).any():
            place = at[at >= 0]
            d, size, held = docs[owner[at >= 0]], n[owner[at >= 0]].astype("u4"), (np.minimum(self.hot.held[place], _HOT - 1) + _HOT).astype("u4")
            rows = [(-1 - p, d[k].tobytes(), size[k].tobytes(), self.hot.tokens[place[k]].tobytes(), held[k].tobytes()) for p, k in _by_part(d, self.parts)]
            tokens, owner = tokens[at < 0], owner[at < 0]
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        cuts = np.searchsorted(tokens, np.array([(b << 64) // self.buckets for b in range(1, self.buckets)], np.uint64)) if self.buckets > 1 else []
        for b, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(tokens)], strict=True)):
            if j > i:
                own, local = np.unique(owner[i:j], return_inverse=True)
                rows.append((b, docs[own].tobytes(), n[own].astype("u4").tobytes(), tokens[i:j].tobytes(), local.astype("u4").tobytes()))
        self.reset()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5))], self.names)


#: Holders of hot tokens count from here, so that they come after all others in every order.
_HOT = 1 << 31


def _bucket(pdf: pd.DataFrame):
    """(documents, sizes, tokens in order, index of each token's document, how many documents hold the token) of a bucket."""
    trim()
    docs = [np.frombuffer(x, np.int64) for x in pdf["docs"]]
    base = np.cumsum([0, *map(len, docs)])
    tokens = np.frombuffer(b"".join(pdf["tokens"]), np.uint64)
    owner = np.concatenate([np.frombuffer(x, "u4") + b for x, b in zip(pdf["owners"], base, strict=False)])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    held = np.diff(np.append(np.flatnonzero(new), len(tokens)))
    return np.concatenate(docs), np.frombuffer(b"".join(pdf["sizes"]), "u4"), tokens, owner, np.repeat(held, held)


def _by_part(docs: np.ndarray, parts: int):
    part = (mix(docs.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(1, parts))
    return [(p, order[i:j]) for p, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(order)], strict=True)) if j > i]


def _with_shared(dealt: DataFrame, parts: int) -> DataFrame:
    """seq of the documents of which enough tokens are held by others."""

    def shared(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:
            docs, at, n = np.unique(np.frombuffer(b"".join(pdf["docs"]), np.int64), return_index=True, return_counts=True)
            sizes = np.frombuffer(b"".join(pdf["sizes"]), "u4")[at]
        else:
            docs, sizes, _, owner, held = _bucket(pdf)
            n = np.bincount(owner[held > 1], minlength=len(docs))
        return pd.DataFrame([(p, docs[k].tobytes(), sizes[k].tobytes(), n[k].astype("u4").tobytes()) for p, k in _by_part(docs, parts)], columns=["part", "docs", "sizes", "n"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, sizes, n = (np.frombuffer(b"".join(pdf[c]), k) for c, k in (("docs", np.int64), ("sizes", "u4"), ("n", "u4")))
        own, at, back = np.unique(docs, return_index=True, return_inverse=True)
        return pd.DataFrame({"seq": own[np.bincount(back, weights=n) >= need(sizes[at].astype(np.int64))]})

    out = dealt.groupBy("bucket").applyInPandas(shared, "part int, docs binary, sizes binary, n binary")
    return out.groupBy("part").applyInPandas(add, "seq long")


def _prefixes(dealt: DataFrame, parts: int) -> DataFrame:
    """seq, n, and the prefixes p0, p1, p2 under the three orders, without tokens that one document alone holds."""

    def holders(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:
            return pd.DataFrame([(-1 - b, *r) for b, *r in pdf.itertuples(index=False)], columns=["part", "docs", "sizes", "tokens", "held"])
        docs, sizes, tokens, owner, held = _bucket(pdf)
        m = held > 1
        tokens, owner, held = tokens[m], owner[m], held[m]
        return pd.DataFrame([(p, docs[owner[k]].tobytes(), sizes[owner[k]].tobytes(), tokens[k].tobytes(), held[k].astype("u4").tobytes()) for p, k in _by_part(docs[owner], parts)], columns=["part", "docs", "sizes", "tokens", "held"])

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, sizes, tokens, held = (np.frombuffer(b"".join(pdf[c]), k) for c, k in (("docs", np.int64), ("sizes", "u4"), ("tokens", np.uint64), ("held", "u4")))
        order = np.argsort(docs, kind="stable")
        docs, sizes, tokens, held = docs[order], sizes[order].astype(np.int64), tokens[order], held[order]
        at = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
        rows = []
        for i, j in zip(at, np.append(at[1:], len(docs))[: len(at)], strict=True):
            n, t, f = int(sizes[i]), tokens[i:j], held[i:j]
            length = n - int(need(n)) + 1 - (n - (j - i))
            if length > 0:
                orders = (np.lexsort((t, f)), np.lexsort((mix(t), f)), np.lexsort((mix(t, 1), np.log2(f).astype(np.int64))))
                rows.append((docs[i], n, *(np.sort(t[o[:length]].view(np.int64)) for o in orders)))
        return pd.DataFrame(rows, columns=["seq", "n", "p0", "p1", "p2"])

    out = dealt.groupBy("bucket").applyInPandas(holders, "part int, docs binary, sizes binary, tokens binary, held binary")
    return out.groupBy("part").applyInPandas(rank, "seq long, n long, p0 array<long>, p1 array<long>, p2 array<long>")


# -- pairs --------------------------------------------------------------------------------------------


def _verified(pairs: DataFrame, prefixes: DataFrame, sets: DataFrame) -> DataFrame:
    """x, y of the pairs (hub, seq) that pass the other filters and the count of their common tokens. pairs is a table; a hub may be in any share of it."""
    a, b = THRESHOLD.numerator, THRESHOLD.denominator
    side = lambda s, c: prefixes.select(F.col("seq").alias(s), F.col("n").alias(f"n{c}"), F.col("p1").alias(f"p1{c}"), F.col("p2").alias(f"p2{c}"))
    c = spread_join(pairs, side("hub", "x"), "hub", "seq").join(side("seq", "y"), "seq")
    c = cut(c.where(f"{b} * least(nx, ny) >= {a} * greatest(nx, ny) AND arrays_overlap(p1x, p1y) AND arrays_overlap(p2x, p2y)").select("hub", "seq"))

    def count(batches):
        for t in batches:
            keep = []
            for s, r in zip(t.column("sx"), t.column("sy"), strict=True):
                s, r = np.frombuffer(s.as_py(), np.uint64), np.frombuffer(r.as_py(), np.uint64)
                i = len(np.intersect1d(s, r, assume_unique=True))
                keep.append(b * i >= a * (len(s) + len(r) - i))
            yield t.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    hubs = sets.select(F.col("seq").alias("hub"), F.col("tokens").alias("sx"))
    c = spread_join(c, hubs, "hub", "seq").join(sets.select("seq", F.col("tokens").alias("sy")), "seq")
    return c.select(F.col("hub").alias("x"), F.col("seq").alias("y"), "sx", "sy").mapInArrow(count, "x long, y long")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for each node of an edge (x, y)."""
    e = cut(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = cut(spread_join(both, least, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, low, "u", "v").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        new = cut(small)
        forget(large)
        now = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        forget(e)
        e = new
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def link_components(prefixes: DataFrame, sets: DataFrame) -> DataFrame:
    """node, component over all links; documents without one are left out."""
    held = cut(prefixes.select("seq", F.explode("p0").alias("token")))
    h = F.xxhash64("seq")
    hubs = held.groupBy("token").agg(F.min_by("seq", h).alias("low"), F.max_by("seq", h).alias("high")).where("low <> high")
    hubs = cut(hubs.select("token", F.explode(F.array("low", "high")).alias("hub")))
    stars = cut(spread_join(held, hubs, "token", "seq").where("hub <> seq").select("hub", "seq").distinct())
    first = cut(_verified(stars, prefixes, sets))
    forget(stars)
    label = components(first)
    second = _across(held, hubs, label, prefixes, sets)
    return components(label.where("node <> component").select(F.col("node").alias("x"), F.col("component").alias("y")).unionAll(second))


def _across(held: DataFrame, hubs: DataFrame, label: DataFrame, prefixes: DataFrame, sets: DataFrame) -> DataFrame:
    """x, y: links between components, of each two components that have any in a pair of blocks at least one.

    Documents whose prefix tokens have holders in several components are put into blocks of about BLOCK_DOCS that share a component
    (or, of small components, a hub). Two blocks meet if they hold a common token; inside a meeting the filters and the count run
    over the pairs of different components.
    """
    named = cut(held.join(label.withColumnRenamed("node", "seq"), "seq", "left").withColumn("c", F.coalesce("component", "seq")).select("token", "seq", "c"))
    mixed = named.groupBy("token").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b").select("token")
    near = mixed.join(hubs.groupBy("token").agg(F.min("hub").alias("hub")), "token")
    named = cut(spread_join(named, near, "token", "seq"))
    docs = cut(named.groupBy("seq", "c").agg(F.min("hub").alias("hub")))
    sizes = docs.groupBy("c").agg(F.count("*").alias("of_c"))
    docs = cut(spread_join(docs, sizes, "c", "seq").withColumn("kind", F.when(F.col("of_c") >= BLOCK_DOCS, F.col("c")).otherwise(-1 - F.col("hub"))))
    count = docs.groupBy("kind").agg(F.count("*").alias("of_kind"))
    docs = spread_join(docs, count, "kind", "seq").select("seq", "c", "kind", F.pmod(F.xxhash64("seq"), F.ceil(F.col("of_kind") / BLOCK_DOCS)).alias("r"))
    docs = cut(docs.withColumn("block", F.struct("kind", "r")).select("seq", "c", "block"))
    packed = docs.join(prefixes, "seq").join(sets.select("seq", "tokens"), "seq").groupBy("block").agg(F.collect_list(F.struct("seq", "c", "n", "p0", "p1", "p2", "tokens")).alias("docs"))
    # a block of one component has it here, others have null
    pure = docs.groupBy("block").agg(F.when(F.min("c") == F.max("c"), F.min("c")).alias("pure"))
    at = named.join(docs.select("seq", "block"), "seq").select("token", "block").distinct().join(pure, "block")
    left, right = at.select("token", F.col("block").alias("a"), F.col("pure").alias("pa")), at.select("token", F.col("block").alias("b"), F.col("pure").alias("pb"))
    meet = left.join(right, "token").where("a <= b AND NOT coalesce(pa = pb, false)").select("a", "b").distinct()
    t = THRESHOLD

    def links(batches):
        for batch in batches:
            xs, ys = [], []
            for k in range(batch.num_rows):
                for x, y in _meeting(batch.column("da")[k].as_py(), batch.column("db")[k].as_py(), t):
                    xs.append(x), ys.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], ["x", "y"])

    both = meet.join(packed.select(F.col("block").alias("a"), F.col("docs").alias("da")), "a").join(packed.select(F.col("block").alias("b"), F.col("docs").alias("db")), "b")
    return both.select("da", "db").mapInArrow(links, "x long, y long")


def _meeting(left: list[dict], right: list[dict], t: Fraction):
    """Links between documents of different components that the links before do not join already."""
    n = [np.array([d["n"] for d in side]) for side in (left, right)]
    c = [np.array([d["c"] for d in side]) for side in (left, right)]
    ok = c[0][:, None] != c[1][None, :]
    ok &= t.denominator * np.minimum(n[0][:, None], n[1][None, :]) >= t.numerator * np.maximum(n[0][:, None], n[1][None, :])
    for p in ("p0", "p1", "p2"):
        ok &= _sharing([d[p] for d in left], [d[p] for d in right])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    sets = [[np.frombuffer(d["tokens"], np.uint64) for d in side] for side in (left, right)]
    for i, j in zip(*np.nonzero(ok), strict=True):
        a, b = find(int(c[0][i])), find(int(c[1][j]))
        if a != b:
            s, r = sets[0][i], sets[1][j]
            both = len(np.intersect1d(s, r, assume_unique=True))
            if t.denominator * both >= t.numerator * (len(s) + len(r) - both):
                root[max(a, b)] = min(a, b)
                yield left[i]["seq"], right[j]["seq"]


def _sharing(left: list[list[int]], right: list[list[int]]) -> np.ndarray:
    """Which lists have a common value."""
    out = np.zeros((len(left), len(right)), bool)
    (x, ox), (y, oy) = ((np.array([v for s in side for v in s], np.int64), np.repeat(np.arange(len(side)), [len(s) for s in side])) for side in (left, right))
    order = np.argsort(y, kind="stable")
    y, oy = y[order], oy[order]
    lo, hi = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
    for o, i, j in zip(ox[hi > lo], lo[hi > lo], hi[hi > lo], strict=True):
        out[o, oy[i:j]] = True
    return out


# -- the operator -------------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of docs (doc_id, text)."""
    docs, simple = number(docs.select("doc_id", "text"))
    out, kind = classes_of(docs), docs.schema["doc_id"].dataType
    if simple:
        return out.select(F.col("seq").cast(kind).alias("doc_id"), "n_shingles", F.col("component").cast(kind).alias("component_id"))
    ids = docs.select("seq", "doc_id")
    return out.join(ids, "seq").join(ids.select(F.col("seq").alias("component"), F.col("doc_id").alias("component_id")), "component").select("doc_id", "n_shingles", "component_id")


def classes_of(docs: DataFrame) -> DataFrame:
    """seq, n_shingles and component (its least seq) of each row of docs (seq, text)."""

    def sign(batches):
        for b in batches:
            rows, more, found, n = [], [], [], 0
            for _, s in token_sets(b.column("text")):
                rows.append((len(s), int(mix(s).sum().view(np.int64)), int(mix(s + np.uint64(7), 1).sum().view(np.int64))))
                found.append(s)
                n += len(s)
                full = n > BLOCK or len(rows) == b.num_rows
                more.append(repeated(found) if full else None)
                if full:
                    found, n = [], 0
            yield pa.RecordBatch.from_arrays([b.column("seq"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array(more, pa.binary())], ["seq", "n_shingles", "s0", "s1", "repeated"])

    signed = cut(docs.mapInArrow(sign, "seq long, n_shingles long, s0 long, s1 long, repeated binary"))
    total = signed.agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("tokens")).first()
    buckets = lambda n: max(8, math.ceil((n or 0) / BUCKET_TOKENS))
    parts = lambda n: max(8, math.ceil(n / PART_DOCS))
    key = ["n_shingles", "s0", "s1"]
    hot = hot_tokens(signed, total["tokens"] or 0)
    signed = signed.drop("repeated")
    classes = signed.where("n_shingles > 0").groupBy(*key).agg(F.min("seq").alias("first"))

    def deal_texts(batches, n, p):
        d = _Dealer(n, p, hot)
        for b in batches:
            seq = b.column("seq").to_pylist()
            for i, s in token_sets(b.column("text")):
                d.add(seq[i], s)
                if d.n > d.most:
                    yield d.flush()
                    trim()
        yield d.flush()
        trim()

    n1, p1 = buckets(total["tokens"]), parts(total["docs"])
    some = _with_shared(docs.select("seq", "text").mapInArrow(lambda it: deal_texts(it, n1, p1), _Dealer.fields), p1)
    some = cut(some.join(classes.select(F.col("first").alias("seq")), "seq"))

    def pack(batches):
        for b in batches:
            found = [s for _, s in token_sets(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("seq"), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["seq", "n", "tokens"])

    sets = cut(docs.select("seq", "text").join(some, "seq").mapInArrow(pack, "seq long, n long, tokens binary"))

    def deal_sets(batches, n, p):
        d = _Dealer(n, p, hot)
        for b in batches:
            for i, s in zip(b.column("seq").to_pylist(), b.column("tokens"), strict=True):
                d.add(i, np.frombuffer(s.as_py(), np.uint64))
                if d.n > d.most:
                    yield d.flush()
                    trim()
        yield d.flush()
        trim()

    def left(sets):
        t = sets.agg(F.count("*").alias("docs"), F.sum("n").alias("tokens")).first()
        n, p = buckets(t["tokens"]), parts(t["docs"])
        return sets.select("seq", "tokens").mapInArrow(lambda it: deal_sets(it, n, p), _Dealer.fields), p

    fewer = cut(sets.join(_with_shared(*left(sets)), "seq"))
    forget(sets)
    prefixes = cut(_prefixes(*left(fewer)))
    label = cut(link_components(prefixes, fewer))
    forget(fewer)
    known = classes.join(label.withColumnRenamed("node", "first"), "first", "left").select(*key, F.coalesce("component", "first").alias("component"))
    out = spread_join(signed.where("n_shingles > 0"), known, key, "seq").select("seq", "n_shingles", "component")
    return out.unionAll(signed.where("n_shingles = 0").select("seq", "n_shingles", "seq"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component the first row, as it is; rows whose text has no words stay."""
    box, names = boxed(docs, "doc_id", "text")
    numbered, _ = number(box)
    first = classes_of(numbered.select("seq", "text")).where("seq = component").select("seq")
    return unboxed(numbered.join(first, "seq", "left_semi"), docs, names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
