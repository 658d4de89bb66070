"""Exact removal of repeated byte strings.

Wanted: every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in an earlier document, or earlier in the same).
That is the order of all suffixes cut off at LENGTH bytes, looked at for equal neighbours. It is built block by block over a cover sample:

1. Cover sample. Of each window of LENGTH bytes the GRAM-byte string with the least hash is its anchor. Two equal windows have
   their anchors at the same place, so - as with a difference cover - any two equal windows meet in a pair of sampled
   places at the same offset; there is an anchor for about (LENGTH - GRAM) / 2 bytes. An anchor is named by the hash of its gram,
   and its context (all windows that it anchors) by a second, longer hash.
2. Blocks. Anchors are dealt into suffix buckets by their gram; each task sorts one bucket at a time. An anchor whose gram is
   nowhere else is done. An anchor whose whole context stood earlier is done too: all its windows are repeats. This settles long
   ties, that is copies of any length and number, by sample names and without comparing text.
3. Ends of repeats. The first anchor of each context, where a gram has more than one context, is left over. Its windows (at most
   LENGTH - GRAM + 1) are named, dealt into buckets and sorted in the same way.
4. The repeats of a document are merged, and cut out of it.

No name gathers more rows in a bucket than there are map batches. Copies inside one batch are settled there: of a context, or a window,
that half of the corpus repeats each batch sends one row. Anchors whose gram has several contexts in their batch (a line in
ever new surroundings) are known to be left over or repeats; they are dealt by their context, and only two of them go to the
gram's bucket, to tell anchors of other batches. Memory of a task: a batch, or a bucket of about ``BUCKET_ANCHORS``
anchors. Contexts and windows are named by 96 bits: at 3e12 anchors one false equality is expected in 10,000 runs.

Defined results: null text is empty; texts under LENGTH bytes lose nothing; of documents with one id the order is that of
their text, then that in which they are read; other columns are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BYTE, BYTE_2, as_buffer, boxed, cut, documents, forget, mix, number, powers, trim, unboxed

LENGTH, GRAM = 100, 32
PIECE = 1 << 18
BUCKET_ANCHORS = 250_000
FLUSH_ANCHORS = 150_000
FLUSH_WINDOWS = 300_000
_PLACE = np.uint64((1 << 20) - 1)


class Hashes:
    """Hashes of all substrings of one buffer of up to two blocks, of 64 bits and of 32 more."""

    def __init__(self, buf: np.ndarray):
        pw, self.inv = powers()
        self.acc, self.acc_2 = self._sums(BYTE[buf], pw), self._sums(BYTE_2[buf], pw)

    def _sums(self, x: np.ndarray, pw: np.ndarray) -> np.ndarray:
        x *= pw[: len(x)]
        acc = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x, out=acc[1:])
        return acc

    def all(self, length: int) -> np.ndarray:
        n = len(self.acc) - length
        return mix((self.acc[length:] - self.acc[:n]) * self.inv[:n])

    def of(self, begin: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        return mix((self.acc[end] - self.acc[begin]) * self.inv[begin] + (end - begin).astype(np.uint64), k)

    def more(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (mix((self.acc_2[end] - self.acc_2[begin]) * self.inv[begin]) >> np.uint64(32)).astype(np.uint32)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    out, have = x, 1
    while 2 * have <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1]) if have < w else out


def anchors(buf: np.ndarray, offs: np.ndarray, h: Hashes) -> tuple[np.ndarray, ...]:
    """(document, first window, last window, anchor place, gram name, context name, more of it) of each anchor, in order. Places are in buf."""
    n = len(buf)
    if n < LENGTH:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64), z.astype(np.uint32)
    grams = h.all(GRAM)
    key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    low = (_sliding_min(key, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(low)]
    valid = np.arange(len(low)) + LENGTH <= offs[doc + 1]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(new & valid)
    stop = np.append(np.flatnonzero(new | ~valid), len(low))
    end = stop[np.searchsorted(stop, begin, "right")] - 1
    at = low[begin]
    return doc[begin], begin, end, at, grams[at], h.of(begin, end + LENGTH, 1) + mix((at - begin).astype(np.uint64)), h.more(begin, end + LENGTH)


def text_pieces(column):
    """(bytes, offsets, row of each part, place of each part in its text): runs of texts of up to PIECE bytes; longer texts are
    cut into parts that overlap so that each window lies in exactly one."""
    data, offs = as_buffer(column)
    rows, starts, ends = [], [], []
    total = 0

    def out():
        o = np.concatenate([[0], np.cumsum(np.array(ends) - np.array(starts))])
        buf = np.concatenate([data[offs[r] + s : offs[r] + e] for r, s, e in zip(rows, starts, ends, strict=True)]) if rows else np.zeros(0, np.uint8)
        return buf, o, np.array(rows, np.int64), np.array(starts, np.int64)

    for r in range(len(offs) - 1):
        size, s = int(offs[r + 1] - offs[r]), 0
        while size - s >= LENGTH:
            e = min(size, s + PIECE)
            if rows and total + e - s > PIECE:
                yield out()
                rows, starts, ends, total = [], [], [], 0
            rows.append(r), starts.append(s), ends.append(e)
            total += e - s
            if e == size:
                break
            s = e - LENGTH + 1
    if rows:
        yield out()


def _blob(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, dtype=kind).tobytes()


#: several: the gram has several contexts in the batch. A row of no windows only tells that of its gram.
_ANCHOR = (("doc", "i8"), ("begin", "u4"), ("windows", "u1"), ("at", "u1"), ("several", "u1"), ("gram", "u8"), ("context", "u8"), ("more", "u4"))
_WINDOW = (("doc", "i8"), ("begin", "u4"), ("gram", "u8"), ("more", "u4"))


def _deal(table: dict[str, np.ndarray], kinds, buckets: int, by: np.ndarray):
    """A row of packed columns for each bucket of the names by. Anchors have low names, being least of their window, so names are mixed again."""
    b = ((mix(by, 1) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((by, b))
    cols = {k: table[k][order] for k, _ in kinds}
    b = b[order]
    for i, j in zip(*_runs(b), strict=True):
        yield (int(b[i]), *(_blob(cols[k][i:j], t) for k, t in kinds))


def _joined(pdf: pd.DataFrame, kinds) -> dict[str, np.ndarray]:
    return {k: np.frombuffer(b"".join(pdf[k]), dtype=t) for k, t in kinds}


def _first_of_equal(*keys: np.ndarray) -> np.ndarray:
    """Keys in sorted order -> whether each row begins a run of equal ones."""
    new = np.zeros(len(keys[0]), bool)
    if len(new):
        new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of equal keys."""
    at = np.flatnonzero(_first_of_equal(key))
    return at, np.append(at[1:], len(key))[: len(at)]


def _by_part(table: dict[str, np.ndarray], kinds, parts: int):
    """A row of packed columns for each part: a slice of the documents by a hash."""
    part = (mix(table["doc"].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, cols = part[order], {k: table[k][order] for k, _ in kinds}
    for i, j in zip(*_runs(part), strict=True):
        yield (int(part[i]), *(_blob(cols[k][i:j], t) for k, t in kinds))


def _rows(rows: list[tuple], kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[1 + k] for r in rows], pa.binary()) for k in range(len(kinds)))], ["bucket", *(k for k, _ in kinds)])


def _batch_anchors(batches, buckets: int):
    """Step 1 on Arrow batches of (seq, text): packed rows; bucket -1 holds repeats that are known already."""
    got: dict[str, list] = {k: [] for k, _ in _ANCHOR}
    n = 0

    def flush():
        table = {k: np.concatenate([np.zeros(0, t), *got[k]]) for k, t in _ANCHOR}
        for v in got.values():
            v.clear()
        order = np.lexsort((table["begin"], table["doc"], table["more"], table["context"], table["gram"]))
        table = {k: v[order] for k, v in table.items()}
        first = _first_of_equal(table["gram"], table["context"], table["more"])
        again = {k: v[~first] for k, v in table.items()}
        table = {k: v[first] for k, v in table.items()}
        at, end = _runs(table["gram"])
        table["several"] = np.repeat(end - at > 1, end - at).astype(np.uint8)
        tell = np.concatenate([at[end - at > 1], at[end - at > 1] + 1])  # two contexts of each such gram
        tell = {k: np.zeros_like(v[tell]) if k in ("windows", "several") else v[tell] for k, v in table.items()}
        by = np.concatenate([np.where(table["several"] > 0, table["context"], table["gram"]), tell["gram"]])
        rows = list(_deal({k: np.concatenate([v, tell[k]]) for k, v in table.items()}, _ANCHOR, buckets, by))
        if not first.all():
            rows.append((-1, *(_blob(again[k], t) if k in _NEEDED else b"" for k, t in _ANCHOR)))
        return _rows(rows, _ANCHOR)

    for b in batches:
        seq = b.column("seq").to_numpy()
        for buf, offs, row, place in text_pieces(b.column("text")):
            part, begin, end, at, gram, context, more = anchors(buf, offs, Hashes(buf))
            for (k, t), v in zip(_ANCHOR, (seq[row[part]], begin - offs[part] + place[part], end - begin + 1, at - begin, np.zeros(len(at)), gram, context, more), strict=True):
                got[k].append(v.astype(t))
            n += len(part)
            if n >= FLUSH_ANCHORS:
                yield flush()
                trim()
                n = 0
    yield flush()
    trim()


_SPAN = (("doc", "i8"), ("begin", "u4"), ("windows", "u1"))
_NEEDED = {k for k, _ in _SPAN}


def _in_spans(doc: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
    """Windows as spans of up to 255 that begin one after the other."""
    order = np.lexsort((begin, doc))
    doc, begin = doc[order], begin[order].astype(np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1] + 1)
    at = np.flatnonzero(new)
    place = np.arange(len(doc)) - np.repeat(at, np.diff(np.append(at, len(doc)))[: len(at)]) if len(at) else np.zeros(0, np.int64)
    at = np.flatnonzero(place % 255 == 0)
    return {"doc": doc[at], "begin": begin[at].astype(np.uint32), "windows": np.diff(np.append(at, len(doc)))[: len(at)].astype(np.uint8)}
_REPEAT = "open boolean, part int, doc binary, begin binary, windows binary"


def _repeat_rows(parts: int, *tables: tuple[bool, dict[str, np.ndarray]]) -> pd.DataFrame:
    return pd.DataFrame([(left, *r) for left, t in tables for r in _by_part(t, _SPAN, parts)], columns=["open", "part", "doc", "begin", "windows"])


def _sort_anchor_bucket(pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Step 2: repeats (open false), and what is left for step 3 (open true)."""
    trim()
    if pdf["bucket"].iloc[0] < 0:
        return _repeat_rows(parts, (False, _joined(pdf, _SPAN)))
    t = _joined(pdf, _ANCHOR)
    order = np.lexsort((t["begin"], t["doc"], t["windows"] == 0, t["more"], t["context"], t["gram"]))
    t = {k: v[order] for k, v in t.items()}
    new_gram = _first_of_equal(t["gram"])
    new = _first_of_equal(t["gram"], t["context"], t["more"])
    group = np.cumsum(new_gram) - 1
    contexts = np.bincount(group, weights=new) if len(group) else np.zeros(0)
    rest = new & ((contexts[group] > 1) | (t["several"] > 0))
    own = t["windows"] > 0
    t, new, rest = {k: v[own] for k, v in t.items()}, new[own], rest[own]
    return _repeat_rows(parts, *((o, {k: t[k][m] for k, _ in _SPAN}) for m, o in ((~new, False), (rest, True))))


def _of_documents(pdf: pd.DataFrame) -> pd.DataFrame:
    """The spans of a part: a row with packed lists for each document."""
    trim()
    t = _joined(pdf, _SPAN)
    order = np.lexsort((t["begin"], t["doc"]))
    doc, begin, windows = (t[k][order] for k, _ in _SPAN)
    at, n = _runs(doc)
    return pd.DataFrame({"seq": doc[at], "begin": [_blob(begin[i:j], "u4") for i, j in zip(at, n, strict=True)], "windows": [_blob(windows[i:j], "u1") for i, j in zip(at, n, strict=True)]})


def _batch_windows(batches, buckets: int):
    """Step 3 on Arrow batches of (seq, text, begin, windows): names of the windows that are left; bucket -1 holds repeats that are known already."""
    got: dict[str, list] = {k: [] for k, _ in _WINDOW}
    total = 0

    def flush():
        table = {k: np.concatenate([np.zeros(0, t), *got[k]]) for k, t in _WINDOW}
        for v in got.values():
            v.clear()
        order = np.lexsort((table["begin"], table["doc"], table["more"], table["gram"]))
        first = np.zeros(len(order), bool)
        first[order[_first_of_equal(table["gram"][order], table["more"][order])]] = True
        rows = list(_deal({k: v[first] for k, v in table.items()}, _WINDOW, buckets, table["gram"][first]))
        if not first.all():  # as spans, the counts in place of the names
            spans = _in_spans(table["doc"][~first], table["begin"][~first])
            rows.append((-1, *(_blob(spans[k], t) for k, t in _SPAN), b""))
        return _rows(rows, _WINDOW)

    for b in batches:
        seq = b.column("seq").to_numpy()
        begins, counts = b.column("begin"), b.column("windows")
        for buf, offs, row, place in text_pieces(b.column("text")):
            h = Hashes(buf)
            for k, (r, s) in enumerate(zip(row.tolist(), place.tolist(), strict=True)):
                begin, n = np.frombuffer(begins[r].as_py(), "u4").astype(np.int64), np.frombuffer(counts[r].as_py(), "u1").astype(np.int64)
                m = (begin >= s) & (begin <= s + offs[k + 1] - offs[k] - LENGTH)
                begin, n = begin[m], n[m]
                if not len(begin):
                    continue
                w = np.repeat(begin, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                at = w - s + offs[k]
                for (c, t), v in zip(_WINDOW, (np.full(len(w), seq[r]), w, h.of(at, at + LENGTH), h.more(at, at + LENGTH)), strict=True):
                    got[c].append(v.astype(t))
                total += len(w)
            if total >= FLUSH_WINDOWS:
                yield flush()
                trim()
                total = 0
    yield flush()
    trim()


def _sort_window_bucket(pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    trim()
    if pdf["bucket"].iloc[0] < 0:
        return _repeat_rows(parts, (False, _joined(pdf.rename(columns={"gram": "windows"}), _SPAN)))
    t = _joined(pdf, _WINDOW)
    order = np.lexsort((t["begin"], t["doc"], t["more"], t["gram"]))
    again = order[~_first_of_equal(t["gram"][order], t["more"][order])]
    return _repeat_rows(parts, (False, _in_spans(t["doc"][again], t["begin"][again])))


def merge_spans(begin: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of bytes covered by the windows starting at begin .. begin + windows - 1."""
    order = np.argsort(begin, kind="stable")
    s, e = begin[order], (begin + windows - 1 + LENGTH)[order]
    far = np.maximum.accumulate(e) if len(e) else e
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > far[:-1]
    at = np.flatnonzero(new)
    return s[at], far[np.append(at[1:], len(s)) - 1] if len(s) else far


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(docs with a column seq in the order of documents, the repeats: seq, begin, windows as packed numbers).

    docs: doc_id, text, and what else is to be kept. seq is doc_id where no id repeats.
    """
    spark = docs.sparkSession
    numbered, _ = number(docs)
    size = numbered.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(64, int(size / ((LENGTH - GRAM + 1) / 2) / BUCKET_ANCHORS) + 1)
    fields = "bucket int, " + ", ".join(f"{k} binary" for k, _ in _ANCHOR)
    dealt = numbered.select("seq", "text").mapInArrow(lambda it: _batch_anchors(it, buckets), fields)
    # repeats known already are many rows of one bucket: they need no sorting and go by document at once
    salted = lambda d: d.withColumn("salt", F.when(F.col("bucket") < 0, F.xxhash64("doc")).otherwise(F.lit(0)))
    sort = lambda pdf: _sort_anchor_bucket(pdf, buckets)
    found = cut(salted(dealt).groupBy("bucket", "salt").applyInPandas(lambda _, pdf: sort(pdf), _REPEAT))
    lists = lambda d: d.select("part", *(k for k, _ in _SPAN)).groupBy("part").applyInPandas(_of_documents, "seq long, begin binary, windows binary")
    rest = numbered.select("seq", "text").join(lists(found.where("open")), "seq")
    windows = rest.mapInArrow(lambda it: _batch_windows(it, buckets), "bucket int, " + ", ".join(f"{k} binary" for k, _ in _WINDOW))
    more = salted(windows).groupBy("bucket", "salt").applyInPandas(lambda _, pdf: _sort_window_bucket(pdf, buckets), _REPEAT)
    both = cut(lists(found.where("NOT open").unionAll(cut(more))))
    forget(found)
    return numbered, both


def remove_repeats(docs: DataFrame, keep: list[str], make) -> DataFrame:
    """make: a function of (bytes, begins, ends) that gives the values of `make.fields`, called for each document."""
    numbered, found = repeats(docs.select(*dict.fromkeys([*keep, "doc_id", "text"])))
    joined = numbered.join(found, "seq", "left")
    names = [f.split()[0] for f in make.fields.split(", ")]
    kinds = [docs.schema[c].dataType.simpleString() for c in keep]

    def run(batches):
        for b in batches:
            data, offs = as_buffer(b.column("text"))
            rows = []
            for k, (x, y) in enumerate(zip(b.column("begin"), b.column("windows"), strict=True)):
                begin = np.frombuffer(x.as_py() or b"", "u4").astype(np.int64)
                s, e = merge_spans(begin, np.frombuffer(y.as_py() or b"", "u1").astype(np.int64))
                rows.append(make(data[offs[k] : offs[k + 1]], s, e))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(make.types))], [*keep, *names])
            trim()

    return joined.select(*dict.fromkeys([*keep, "text", "begin", "windows"])).mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in zip(keep, kinds, strict=True)) + ", " + make.fields)


def kept_bytes(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    if not len(begin):
        return text.tobytes()
    return b"".join(text[a:b].tobytes() for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True))


def _report(text, begin, end):
    return len(text), int((end - begin).sum()), len(begin), hashlib.sha256(kept_bytes(text, begin, end)).hexdigest()


_report.fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_report.types = (pa.int64(), pa.int64(), pa.int64(), pa.string())


def _rest(text, begin, end):
    return (kept_bytes(text, begin, end).decode("utf-8", "ignore"),)


_rest.fields = "_rest string"
_rest.types = (pa.string(),)


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs without the repeated bytes; documents of which nothing is left, but that had text, go. n_chars, if there, is counted again.

    A character cut in two by the end of a repeat goes as a whole. Null text stays null.
    """
    box, names = boxed(docs, "doc_id", "text")
    own = dict(zip(docs.columns, names, strict=True))
    out = remove_repeats(box, names, _rest).where(f"_rest <> '' OR coalesce({own['text']}, '') = ''")
    other = {"text": F.when(F.col(own["text"]).isNotNull(), F.col("_rest"))}
    if "n_chars" in own:
        other["n_chars"] = F.length("_rest").cast(docs.schema["n_chars"].dataType)
    return unboxed(out, docs, names, **other)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), ["doc_id"], _report)
