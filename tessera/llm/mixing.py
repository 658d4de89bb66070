"""Mixing sources to target weights.

Each source's words are packed into blocks of ``block_words`` (its documents one after the other). An output shard has a fixed
number of slots; how many of them each source fills is drawn from the multinomial distribution, conditioned on the sums over
all shards, which are fixed from the targets: the last slot of a source is cut off where its words reach the target, rounded to a
word. The j-th slot of a source is in epoch j div blocks, and takes the block that a pseudorandom permutation of the source's block
numbers, keyed by seed, source and epoch, gives for j mod blocks. Slots and blocks meet in a join by (source, block).

The permutation is computed, not stored, so no order of the corpus is ever collected, and a lost task makes the same rows again.
Documents are packed in the order of a hash of their id and text, so the mix is the same however the table is partitioned.
Driver data: two numbers for each source. Defined results: null text has size 0; a null source is one source,
ranked last; sources without words get target 0; repeated rows are separate; other columns are never read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, documents, pieces, word_spans

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 256
SLOTS = 4096


def sizes(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: row (a number of its own), key (a hash of id and text), doc_id, source, size."""

    def run(batches):
        for b in batches:
            n = np.concatenate([np.zeros(0, np.int64), *(np.diff(word_spans(buf, offs)[2]) for _, _, buf, offs in pieces(b.column("text")))])
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("doc_id"), b.column("source"), pa.array(n)], ["key", "doc_id", "source", "size"])

    kinds = [docs.schema[c].dataType.simpleString() for c in ("doc_id", "source")]
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "source", "text")
    out = keyed.mapInArrow(run, f"key long, doc_id {kinds[0]}, source {kinds[1]}, size long")
    return cut(out.withColumn("row", F.monotonically_increasing_id()))


def targets(size: DataFrame, weights=WEIGHTS, share: float = 1.0, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """A row for each source: rank, source_size, target. Water filling in closed form: by cap / weight, the first ones are at their cap."""
    src = size.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = src.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("w") * F.col("level"))
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(whole)
    return ranked.select("source", F.col("rank").cast("long").alias("rank"), "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * final).alias("target"))


def _split(rng: np.random.Generator, counts: np.ndarray, take: int) -> np.ndarray:
    """How many of each kind are among take drawn without replacement."""
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, c in enumerate(map(int, counts)):
        rest -= c
        if not c or not take:
            continue
        if c + rest < 10**9:
            x = int(rng.hypergeometric(c, rest, take)) if rest else take
        else:  # NumPy's limit: the normal law, whose error is far under a block's share here
            n = c + rest
            var = take * (c / n) * (rest / n) * (n - take) / max(1, n - 1)
            x = round(rng.normal(take * c / n, math.sqrt(max(0.0, var))))
        x = min(max(x, take - rest, 0), c, take)
        out[i], take = x, take - x
    return out


def shard_counts(totals: np.ndarray, slots: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source before a shard and in it: multinomial given that the sums over all shards are totals. Any shard alone, in log(shards) draws."""
    total = int(totals.sum())
    lo, hi, counts, before = 0, max(1, -(-total // slots)), totals, np.zeros_like(totals)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _split(np.random.default_rng([seed, lo, hi]), counts, (mid - lo) * slots)
        lo, hi, counts, before = (lo, mid, left, before) if shard < mid else (mid, hi, counts - left, before + left)
    return before, counts


def permute(i: np.ndarray, n: int, key: str, back: bool = False) -> np.ndarray:
    """Image of each i < n under a keyed pseudorandom permutation of 0..n-1 (Feistel network, walked until inside), or back."""
    half = max(1, math.ceil(math.log2(max(2, n)) / 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(hashlib.blake2b(key.encode(), digest_size=32).digest(), np.uint64)
    out = np.asarray(i).astype(np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys[::-1] if back else keys:
            f = ((left if back else right) + k) * np.uint64(0x9E3779B97F4A7C15)
            f = ((f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)) & mask
            left, right = (right ^ f, left) if back else (right, left ^ f)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def needed_slots(size: int, words: int, block_words: int, rank: int, seed: int) -> tuple[int, int]:
    """(slots, words that the last one gives) of a source of size words that is to give that many."""
    if not size or not words:
        return 0, 0
    blocks = -(-size // block_words)
    short = size - (blocks - 1) * block_words
    whole, rest = divmod(words, size)
    if not rest:
        return whole * blocks, short if permute(np.array([blocks - 1]), blocks, f"{seed}/{rank}/{whole - 1}")[0] == blocks - 1 else block_words
    # the last epoch: the short block stands at place p, so slots after it give less by what it lacks
    p = int(permute(np.array([blocks - 1]), blocks, f"{seed}/{rank}/{whole}", back=True)[0])
    slots = -(-rest // block_words)
    if slots > p:
        slots = max(p + 1, -(-(rest + block_words - short) // block_words))
    before = (slots - 1) * block_words - (block_words - short if p < slots - 1 else 0)
    return whole * blocks + slots, rest - before


def block_pieces(size: DataFrame, target: DataFrame, block_words: int = BLOCK_WORDS, chunk_rows: int = 1024) -> DataFrame:
    """rank, block, row, pos, words: which words of which row lie in each block, and where in it they begin.

    Running sums go by (source, chunk), chunks being dealt by the hash of a row so that a source with a third of all rows is many
    groups; then over the sums of chunks in groups of chunk_rows, then over the groups.
    """
    chunks = max(1, -(-size.count() // chunk_rows))
    t = target.select(F.col("source").alias("_s"), "rank")
    s = size.where("size > 0").join(t, F.col("source").eqNullSafe(F.col("_s"))).select("rank", "row", "key", "doc_id", "size", F.pmod("key", F.lit(chunks)).alias("chunk"))
    before = lambda c, by, order: F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = cut(s.groupBy("rank", "chunk").agg(F.sum("size").alias("n"))).withColumn("group", F.expr(f"chunk div {chunk_rows}"))
    groups = per.groupBy("rank", "group").agg(F.sum("n").alias("n")).select("rank", "group", before("n", ["rank"], ["group"]).alias("start"))
    per = per.join(groups, ["rank", "group"]).select("rank", "chunk", (F.col("start") + before("n", ["rank", "group"], ["chunk"])).alias("start"))
    # rows that tie in all of this are copies of each other
    s = s.withColumn("at", before("size", ["rank", "chunk"], ["key", "doc_id", "row"])).join(per, ["rank", "chunk"]).withColumn("at", F.col("at") + F.col("start"))
    b = F.lit(block_words)
    s = s.select("rank", "row", "size", "at", F.explode(F.sequence(F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}"))).alias("block"))
    begin, end = F.greatest(F.col("block") * b, "at"), F.least((F.col("block") + 1) * b, F.col("at") + F.col("size"))
    return s.select("rank", "block", "row", (begin - F.col("block") * b).alias("pos"), (end - begin).alias("words"))


def slots(spark: SparkSession, target: DataFrame, block_words: int = BLOCK_WORDS, per_shard: int = SLOTS, seed: int = 7) -> DataFrame:
    """shard, rank, slot (of its source), block, limit (words that the slot takes at most): what each output shard holds."""
    known = {r["rank"]: (r["source_size"], r["target"]) for r in target.collect()}
    n = len(known)
    blocks = np.array([-(-known[i][0] // block_words) for i in range(n)], np.int64)
    ends = [needed_slots(known[i][0], min(round(known[i][1]), MAX_REPEAT * known[i][0]), block_words, i, seed) for i in range(n)]
    want, last = (np.array([e[k] for e in ends], np.int64) for k in (0, 1))
    shards = -(-int(want.sum()) // per_shard)

    def deal(frames):
        for f in frames:
            for shard in f["id"]:
                before, c = shard_counts(want, per_shard, int(shard), seed)
                k = np.flatnonzero(c)
                yield pd.DataFrame({"shard": int(shard), "rank": k, "start": before[k], "count": c[k]})

    parts = max(1, min(shards, max(spark.sparkContext.defaultParallelism, shards // 64)))
    counts = spark.range(0, shards, numPartitions=parts).mapInPandas(deal, "shard long, rank long, start long, count long")
    dealt = counts.select("shard", "rank", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("count") - 1)).alias("slot"))

    def place(frames):
        for f in frames:
            out = np.zeros(len(f), np.int64)
            rank, slot = f["rank"].to_numpy(), f["slot"].to_numpy()
            for r in np.unique(rank):
                m, nb = np.flatnonzero(rank == r), int(blocks[r])
                epoch = slot[m] // nb
                for e in np.unique(epoch):
                    own = m[epoch == e]
                    out[own] = permute(slot[own] % nb, nb, f"{seed}/{r}/{e}")
            yield f.assign(block=out, limit=np.where(slot == want[rank] - 1, last[rank], block_words))

    return dealt.mapInPandas(place, "shard long, rank long, slot long, block long, limit long")


def mix(docs: DataFrame, seed: int = 7, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes of the rows, targets of the sources, the mix: shard, rank, slot, block, row, pos, words)."""
    size = sizes(docs)
    target = cut(targets(size))
    out = slots(docs.sparkSession, target, block_words, seed=seed).join(block_pieces(size, target, block_words).hint("merge"), ["rank", "block"])  # both grow with the input
    out = out.withColumn("words", F.least("words", F.col("limit") - F.col("pos"))).where("words > 0")
    return size, target, out.drop("limit")


def digest(docs: DataFrame) -> DataFrame:
    size, target, out = mix(docs)
    taken = out.groupBy("row").agg(F.sum("words").alias("taken"))
    t = target.select(F.col("source").alias("_s"), "source_size", "target")
    joined = size.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").join(taken.hint("merge"), "row", "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(documents(spark, sf_dir))


def targets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What query gives without the draws: doc_id, size, source_size, target."""
    size = sizes(documents(spark, sf_dir))
    t = targets(size).withColumnRenamed("source", "_s")
    return size.join(t, F.col("source").eqNullSafe(F.col("_s"))).select("doc_id", "size", "source_size", "target")
