"""Shared pieces of the corpus operators: intermediate tables, Arrow text access, word and window hashes.

Text is handled as one UTF-8 byte buffer for many documents at a time, so that the work per byte is a few
NumPy operations and no Python object is made for a word.
"""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
#: Random 64-bit value of each byte, and the same with A-Z folded to a-z.
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]
#: Random values of bytes for a second hash.
BYTE_2 = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BLOCK = 1 << 19
#: A key, or a token, that fewer rows hold is never hot.
HOT_ROWS = 1000
#: Rows that go to a Python worker at once at most.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_MIX = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53))
#: Space and \t \n \v \f \r part words.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: dict[str, np.ndarray] = {}


def powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for one block, made once per process."""
    if not _POW:
        _POW["p"], _POW["i"] = _powers(BASE, 2 * BLOCK + 1), _powers(BASE_INV, 2 * BLOCK + 1)
    return _POW["p"], _POW["i"]


def mix(x: np.ndarray, k: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser; k picks one of two."""
    x = x ^ (x >> U(30))
    x = x * _MIX[2 * k]
    x ^= x >> U(27)
    x *= _MIX[2 * k + 1]
    x ^= x >> U(31)
    return x


# -- intermediate tables ------------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where neither setting nor context has any, and all tasks run on this machine."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not d:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jsc.isDefined():
            d = jsc.get()
        else:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            d = "file://" + tempfile.mkdtemp(prefix="tessera-")
            spark.sparkContext.setCheckpointDir(d)
    return d


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands whole texts to Python workers a thousand at a time, not ten thousand."""
    rows = int(spark.conf.get(_BATCH))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


_libc = ctypes.CDLL(None)


def trim() -> None:
    """Give freed memory back: Python workers live on from stage to stage beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there and lost executors cost nothing before it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera-{uuid.uuid4().hex}"
    small_batches(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove a table made by cut() that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/tessera-" in path:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def spread_join(many: DataFrame, one: DataFrame, key: str | list[str], by: str, most: int = 100_000) -> DataFrame:
    """Inner join of many (a table that can be read twice) with one, which has few rows for each key; a key may hold any share of many's rows.

    Keys with more than a most-th of the rows, of which there can't be more than most, are broadcast with a number of salts;
    their rows are dealt by a hash of column by, and one's rows are repeated for each salt.
    """
    key = [key] if isinstance(key, str) else key
    limit = max(HOT_ROWS, many.count() // most)
    hot = many.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*key, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))
    hot = F.broadcast(cut(hot))
    left = many.join(hot, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), "_salts").cast("int"), F.lit(0))).drop("_salts")
    right = one.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [*key, "_salt"]).drop("_salt")


def boxed(docs: DataFrame, *own: str) -> tuple[DataFrame, list[str]]:
    """The columns own, and all columns under names of this library, so that none of docs can clash; those names."""
    names = [f"_k{i}" for i in range(len(docs.columns))]
    return docs.select(*own, *(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True))), names


def unboxed(df: DataFrame, docs: DataFrame, names: list[str], **other) -> DataFrame:
    """The columns of docs again; other: what stands in for some."""
    return df.select(*(other.get(c, F.col(n)).alias(c) for c, n in zip(docs.columns, names, strict=True)))


def number(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Adds seq, a different number for each row in the order of doc_id, nulls last; whether it is doc_id itself, as it is where no id repeats or is null."""
    if dict(docs.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint") and docs.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn("seq", F.col("doc_id").cast("long")), True
    return cut(docs.orderBy(F.asc_nulls_last("doc_id"), "text").withColumn("seq", F.monotonically_increasing_id())), False


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(column: str, m: int):
    return F.expr(f"crc32(cast({column} as string)) % {m}")


# -- Arrow text ---------------------------------------------------------------------------------------


def as_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values one after the other, and len+1 offsets; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.string(), pa.binary(), pa.large_string(), pa.large_binary()):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    wide = column.type in (pa.large_string(), pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def pieces(column, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about limit bytes; a longer text stands alone."""
    data, offs = as_buffer(column)
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each document (and after the last) the index of its first word."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    word = ~IS_SPACE[buf]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = offs[offs < n]
    first[edge] = word[edge]
    edge = offs[offs > 0] - 1
    last[edge] = word[edge]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word, the same on every machine; lower: A-Z count as a-z."""
    out = np.zeros(len(starts), np.uint64)
    table = BYTE_LOWER if lower else BYTE
    pw, inv = powers()
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        s0 = int(starts[i])
        if int(ends[j - 1]) - s0 > 2 * BLOCK:  # one word of more than a block
            word = buf[s0 : int(ends[i])].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(_lower(word) if lower else word, digest_size=8).digest(), "little")
            i += 1
            continue
        seg = table[buf[s0 : int(ends[j - 1])]]
        seg *= pw[: len(seg)]
        acc = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(seg, out=acc[1:])
        s, e = starts[i:j] - s0, ends[i:j] - s0
        out[i:j] = mix((acc[e] - acc[s]) * inv[s] + (e - s).astype(np.uint64))
        i = j
    return out


def _lower(word: bytes) -> bytes:
    return word.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


def shingle_hashes(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size words inside one document, and for each document the index of its first one.

    A document with fewer words, but at least one, has its whole sequence as its only run.
    """
    count = np.diff(first)
    runs = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(runs)])
    out = np.zeros(int(at[-1]), np.uint64)
    n = len(h) - size + 1
    if n > 0:
        s = h[:n].copy()
        for k in range(1, size):
            s ^= s >> U(29)
            s *= _MIX[k % 4]
            s += h[k : k + n]
        s = mix(s)
        long = count >= size
        keep = np.zeros(n + 1, np.int64)
        np.add.at(keep, first[:-1][long], 1)
        np.add.at(keep, first[:-1][long] + runs[long], -1)
        dest = np.zeros(len(out), bool)
        np.logical_or.at(dest, at[:-1][~long & (runs > 0)], True)
        out[~dest] = s[np.cumsum(keep[:-1]) > 0]
    for d in np.flatnonzero((count < size) & (count > 0)):
        x = h[first[d] : first[d + 1]]
        out[at[d]] = int.from_bytes(hashlib.blake2b(x.tobytes() + b"short", digest_size=8).digest(), "little")
    return out, at
