"""Benchmark decontamination with spaced seeds.

A mask of kept and ignored word places slides over the test items and over the documents; the kept words are hashed. A document
place and an item place with the same hash under the same mask lie on a diagonal, and the words around are compared along it. The
best run (a point for an equal word, MISS off for another) decides: an item leaks into a document if the run holds at
least ``min_words`` equal words, or ``min_share`` of the item if that is fewer. Replaced words therefore neither hide a hit
(each mask ignores other places) nor end a run.

The documents are read once and never shuffled: hashes of the test items are joined inside the map task. What is sent
to the tasks holds at most ``max_keys`` hashes; a larger test set is dealt into that many rounds over the documents (see
``slices``), each exact for its items.

Defined results: words are split at white space with A-Z folded; null or empty texts and items leak nothing; an item of fewer
words than the shortest mask leaks where all its words stand in a row; repeated rows are judged one by one, and repeated items each count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import as_buffer, documents, mix, pieces, word_hashes, word_spans

MASKS = ("1101011", "1110011", "11011011", "10110111")
MISS = 1.5
MIN_WORDS, MIN_SHARE = 13, 0.6
MAX_KEYS = 1_000_000
_BITS = 20
#: Hits of seeds that are looked at together.
_HITS = 1_000_000
_SHORT = min(map(len, MASKS))


def _masks_of(n: int) -> list[tuple[int, str]]:
    """(number, mask) for an item of n words; one of fewer than any mask has is one key of all its words."""
    return list(enumerate(MASKS)) if n >= _SHORT else [(len(MASKS) + n, "1" * n)] if n else []


def seed_keys(h: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the kept words at each place where the mask fits."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, number + 1, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out ^= out >> np.uint64(29)
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += h[k : k + n]
    return mix(out)


@dataclass
class Items:
    """Test items of one slice: ids, word hashes one after the other with offsets, and the sorted seed keys with their places."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    keys: np.ndarray
    item: np.ndarray
    at: np.ndarray
    seen: np.ndarray
    masks: list

    @staticmethod
    def of(ids: list, texts: list) -> Items:
        buf, offs = as_buffer(pa.array(texts, pa.string()))
        starts, ends, first = word_spans(buf, offs)
        h = word_hashes(buf, starts, ends, lower=True)
        keys, item, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        used: set[tuple[int, str]] = set()
        for i, n in enumerate(np.diff(first).tolist()):
            used.update(_masks_of(n))
            for m, mask in _masks_of(n):
                k = seed_keys(h[first[i] : first[i + 1]], mask, m)
                keys.append(k), item.append(np.full(len(k), i)), at.append(np.arange(len(k)))
        keys, item, at = map(np.concatenate, (keys, item, at))
        order = np.argsort(keys, kind="stable")
        seen = np.zeros(1 << _BITS, bool)
        seen[(keys & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        return Items(ids, h, first, keys[order], item[order], at[order], seen, sorted(used))


def best_run(equal: np.ndarray) -> tuple[int, int, int]:
    """(equal words, begin, end) of the run with the highest score; it begins and ends with an equal word."""
    score = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -MISS))])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    begin = int(np.argmin(score[: end + 1]))
    return int(equal[begin:end].sum()), begin, end


def leaks(column, items: Items, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE):
    """Row number, item number, equal words, first and last place (in words of the text) for each leak; the best of each row and item."""
    for i0, _, buf, offs in pieces(column):
        starts, ends, first = word_spans(buf, offs)
        h = word_hashes(buf, starts, ends, lower=True)
        found = [np.zeros(0, np.int64)]  # diagonals: the item's word 0 stands at the text's word shift
        least, span = -int(np.diff(items.first).max(initial=0)), len(h) + int(np.diff(items.first).max(initial=0)) + 1
        for m, mask in items.masks:
            k = seed_keys(h, mask, m)
            p = np.flatnonzero(items.seen[(k & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
            lo, hi = np.searchsorted(items.keys, k[p], "left"), np.searchsorted(items.keys, k[p], "right")
            doc = np.searchsorted(first, p, "right") - 1
            ok = (hi > lo) & (p + len(mask) <= first[doc + 1])
            p, lo, doc, n = p[ok], lo[ok], doc[ok], (hi - lo)[ok]
            sums = np.cumsum(n)
            i = 0
            while i < len(p):  # so many places at once that their hits stay bounded
                j = max(i + 1, int(np.searchsorted(sums, (sums[i - 1] if i else 0) + _HITS, "right")))
                x = np.repeat(lo[i:j] - np.cumsum(n[i:j]) + n[i:j], n[i:j]) + np.arange(int(n[i:j].sum()))
                shift = np.repeat(p[i:j], n[i:j]) - items.at[x]
                found.append(np.unique((np.repeat(doc[i:j], n[i:j]) * len(items.ids) + items.item[x]) * span + shift - least))
                i = j
        diagonals = np.unique(np.concatenate(found))
        pair, shifts = np.divmod(diagonals, span)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for d, i, shift in zip(*(v.tolist() for v in np.divmod(pair, max(1, len(items.ids)))), (shifts + least).tolist(), strict=True):
            words = items.words[items.first[i] : items.first[i + 1]]
            lo, hi = max(int(first[d]), shift), min(int(first[d + 1]), shift + len(words))
            n, b, e = best_run(h[lo:hi] == words[lo - shift : hi - shift])
            if n >= min(min_words, int(np.ceil(min_share * len(words)))):
                best[d, i] = max(best.get((d, i), (0, 0, 0)), (n, lo + b - int(first[d]), lo + e - int(first[d])))
        for (d, i), (n, b, e) in sorted(best.items()):
            yield i0 + d, i, n, b, e


def slices(benchmark: DataFrame, max_keys: int = MAX_KEYS):
    """The test items in parts of about max_keys seed keys at most."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    keys = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    parts = max(1, -(-2 * len(MASKS) * keys // max_keys))
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect() if keys else []
        yield Items.of([r["item_id"] for r in rows], [r["text"] for r in rows])


def find(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """A row for each leak: doc_id, item_id, item_words, equal_words, begin_word, end_word."""
    spark, kind, item_kind = docs.sparkSession, docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    out = None
    for part in slices(benchmark):
        sent = spark.sparkContext.broadcast(part)

        def run(batches, sent=sent):
            x = sent.value
            for b in batches:
                found = list(leaks(b.column("text"), x, **how))
                rows = pa.array([f[0] for f in found], pa.int64())
                n = np.diff(x.first)
                cols = [b.column("doc_id").take(rows), pa.array([x.ids[f[1]] for f in found], item_type), pa.array([int(n[f[1]]) for f in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4))], names)

        from pyspark.sql.pandas.types import to_arrow_type

        item_type = to_arrow_type(item_kind)
        names = ["doc_id", "item_id", "item_words", "equal_words", "begin_word", "end_word"]
        got = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, item_id {item_kind.simpleString()}, item_words long, equal_words long, begin_word long, end_word long")
        out = got if out is None else out.unionAll(got)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of docs into which no item leaks, as they are."""
    out = docs
    for part in slices(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches, sent=sent):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[f[0] for f in leaks(b.column("text"), sent.value, **how)]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
