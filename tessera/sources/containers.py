"""Asset containers: compression, archives of several files in one blob, index files, SQLite containers, extracted folders.

A file of a container is a row major, minor, data; an unpacked file is a row major, minor, fileid, namehash, offset, bytes. Blobs are
unpacked in Arrow batches on the executors; a bad blob gives a row with its error, and the others go on.
"""

from __future__ import annotations

import bz2
import gzip
import lzma
import re
import sqlite3
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.functions.hashes import xtea
from tessera.functions.text import legacy_name_hash, name_hash

#: Fixed value: how a blob in a SQLite container begins.
SQLITE_MAGIC = b"ZLB\x01"

# -- compression --------------------------------------------------------------------------------------


def decompress(blob: bytes, key: bytes | None = None) -> bytes:
    """The content of a blob; its first byte says how it is packed: 0 not, 1 bzip2, 2 gzip (with a key, enciphered), 3 LZMA, Z zlib."""
    kind = blob[0]
    if blob[:4] == SQLITE_MAGIC:
        return zlib.decompress(blob[8:])
    if kind > 3:
        raise ValueError(f"unknown compression {kind}")
    size = int.from_bytes(blob[1:5], "big")
    if kind == 0:
        return blob[5 : 5 + size].ljust(size, b"\0")
    if kind == 1:
        return bz2.decompress(b"BZh9" + blob[9 : 9 + size])
    if kind == 3:
        return lzma.LZMADecompressor(lzma.FORMAT_ALONE).decompress(blob[9:14] + int.from_bytes(blob[5:9], "big").to_bytes(8, "little") + blob[14 : 9 + size])
    inner = xtea(blob[5 : 9 + size], key)[4:] if key else blob[9 : 9 + size]
    try:
        return zlib.decompress(inner, 31)
    except zlib.error as e:
        raise ValueError(f"gzip fails, perhaps for a missing or wrong key: {e}") from None


def compress(data: bytes, kind: str = "sqlite") -> bytes:
    """The inverse of decompress for kinds sqlite, none, bzip2, gzip."""
    size = len(data).to_bytes(4, "big")
    if kind == "sqlite":
        return SQLITE_MAGIC + size + zlib.compress(data)
    if kind == "none":
        return b"\0" + size + data
    packed = bz2.compress(data)[4:] if kind == "bzip2" else gzip.compress(data, mtime=0)
    return (b"\1" if kind == "bzip2" else b"\2") + len(packed).to_bytes(4, "big") + size + packed


def decompressed(files: DataFrame, column: str = "data", key: bytes | None = None) -> DataFrame:
    """files with column decompressed, and error, null where that went well; null stays null."""
    names = [c for c in files.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, errors = [], []
            for v in b.column(column).to_pylist():
                try:
                    out.append(None if v is None else decompress(v, key)), errors.append(None)
                except Exception as e:  # a bad blob must not stop the others
                    out.append(None), errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out, pa.binary()), pa.array(errors, pa.string())], [*names, column, "error"])

    fields = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in names)
    return files.select(*names, column).mapInArrow(run, f"{fields}{', ' if names else ''}`{column}` binary, error string")


# -- archives -----------------------------------------------------------------------------------------


def split_network(data: bytes, n: int) -> list[tuple[int, bytes]]:
    """(offset, bytes) of the n files of an archive that ends in a table of sizes: for each chunk the differences from file to file, then the number of chunks."""
    if n == 1:
        return [(0, data)]
    chunks = data[-1]
    sizes = np.cumsum(np.frombuffer(data, ">i4", n * chunks, len(data) - 1 - 4 * n * chunks).reshape(chunks, n), axis=1)
    ends = np.cumsum(sizes.ravel()).reshape(chunks, n)
    begins = ends - sizes
    return [(int(begins[0, k]) if chunks else 0, b"".join(data[begins[c, k] : ends[c, k]] for c in range(chunks))) for k in range(n)]


def join_network(files: list[bytes]) -> bytes:
    if len(files) == 1:
        return files[0]
    sizes = np.diff(np.array([0, *map(len, files)])).astype(">i4")
    return b"".join([*files, sizes.tobytes(), b"\1"])


def split_table(data: bytes, n: int) -> list[tuple[int, bytes]]:
    """(offset, bytes) of the n files of an archive that begins with a byte and the places where files begin and end."""
    if n == 1:
        return [(0, data)]
    at = np.frombuffer(data, ">u4", n + 1, 1).astype(int)
    return [(int(a), data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def join_table(files: list[bytes]) -> bytes:
    if len(files) == 1:
        return files[0]
    at = 5 + 4 * len(files) + np.cumsum([0, *map(len, files)])
    return b"".join([b"\1", at.astype(">u4").tobytes(), *files])


def split_legacy(data: bytes) -> list[tuple[int, int, bytes]]:
    """(name hash, offset, bytes) of an old archive: two sizes, a directory of (hash, size, packed size), the files; bzip2 where the sizes differ."""
    size, packed = int.from_bytes(data[:3], "big"), int.from_bytes(data[3:6], "big")
    data = data[6:]
    if size != packed:
        data = bz2.decompress(b"BZh9" + data)
        if len(data) != size:
            raise ValueError("decompressed to another size")
    n = int.from_bytes(data[:2], "big")
    at, out = 2 + 10 * n, []
    for k in range(n):
        h, = struct.unpack_from(">I", data, 2 + 10 * k)
        size, packed = (int.from_bytes(data[2 + 10 * k + o : 5 + 10 * k + o], "big") for o in (4, 7))
        part = data[at : at + packed]
        if size != packed:
            part = bz2.decompress(b"BZh9" + part)
            if len(part) != size:
                raise ValueError("decompressed to another size")
        out.append((h, at, part))
        at += packed
    return out


_FILE = "major int, minor int, fileid int, namehash long, offset long, bytes binary, error string"


def unpacked(archives: DataFrame, form: str) -> DataFrame:
    """A row for each file of archives (major, minor, data, subindices, subnames); form: network, table or legacy (which needs neither list)."""
    split = {"network": split_network, "table": split_table}.get(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                try:
                    if split is None:
                        found = [(k, h, at, part) for k, (h, at, part) in enumerate(split_legacy(r["data"]))]
                    else:
                        ids = r["subindices"]
                        names = r["subnames"] or [None] * len(ids)
                        found = [(i, h, at, part) for i, h, (at, part) in zip(ids, names, split(r["data"], len(ids)), strict=True)]
                    rows += [(r["major"], r["minor"], *f, None) for f in found]
                except Exception as e:  # a bad archive must not stop the others
                    rows.append((r["major"], r["minor"], None, None, None, None, f"{type(e).__name__}: {e}"))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [f.split()[0] for f in _FILE.split(", ")])

    cols = ["major", "minor", "data"] + (["subindices", "subnames"] if split else [])
    return archives.select(*cols).mapInArrow(run, _FILE)


def packed(files: DataFrame, form: str) -> DataFrame:
    """major, minor, subindices, data: one archive of the files (major, minor, fileid, bytes) of each minor, in the order of fileid; form: network or table."""
    join = {"network": join_network, "table": join_table}[form]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        f = pdf.sort_values("fileid")
        return pd.DataFrame({"major": f["major"].iloc[:1], "minor": f["minor"].iloc[:1], "subindices": [f["fileid"].tolist()], "data": [join(f["bytes"].tolist())]})

    return files.select("major", "minor", "fileid", "bytes").groupBy("major", "minor").applyInPandas(run, "major int, minor int, subindices array<int>, data binary")


def merged_edits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Files of the archives that new touches, new bytes before old ones. A fileid that its archive doesn't have stops the query."""
    key = ["major", "minor", "fileid"]
    touched = new.select("major", "minor").distinct()
    own = old.join(touched, ["major", "minor"], "left_semi").select(*key, F.col("bytes").alias("_old"), F.lit(True).alias("_known"))
    both = own.join(new.select(*key, F.col("bytes").alias("_new")), key, "full")
    known = F.when(F.col("_known"), F.coalesce("_new", "_old")).otherwise(F.raise_error(F.format_string("archive %d.%d has no file %d", *key)).cast("binary"))
    return both.select(*key, known.alias("bytes"))


def archive_sizes(files: DataFrame) -> DataFrame:
    """major, minor, size: the sum of the sizes of the files of each archive."""
    return files.groupBy("major", "minor").agg(F.sum(F.octet_length("bytes")).alias("size"))


# -- index files --------------------------------------------------------------------------------------

INDEX = "major int, minor int, name long, crc long, version long, size long, uncompressed_size long, uncompressed_crc long, subindexcount int, subindices array<int>, subnames array<long>"


class _Bytes:
    """Numbers of one kind after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def column(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += out.nbytes
        return out.astype(np.int64)

    def small_or_large(self) -> int:
        """Two bytes, or four if the top bit is set."""
        wide = self.data[self.at] >> 7
        return int(self.column(">u4", 1)[0]) & 0x7FFFFFFF if wide else int(self.column(">u2", 1)[0])


def read_index(data: bytes, major: int) -> list[dict]:
    """Rows of INDEX from an index file, which holds column after column; numbers of minors and files are differences."""
    b = _Bytes(data)
    form = int(b.column("u1", 1)[0])
    if form >= 6:
        b.column(">u4", 1)
    flags = int(b.column("u1", 1)[0])
    n = b.small_or_large() if form >= 7 else int(b.column(">u2", 1)[0])
    none = [None] * n
    out = {"minor": np.cumsum(b.column(">u2", n)).tolist()}
    out["name"] = b.column(">u4", n).tolist() if flags & 1 else none
    out["crc"] = b.column(">u4", n).tolist()
    out["uncompressed_crc"] = b.column(">u4", n).tolist() if flags & 4 else none
    sizes = b.column(">u4", 2 * n).reshape(n, 2) if flags & 4 else None
    out["size"], out["uncompressed_size"] = (none, none) if sizes is None else (sizes[:, 0].tolist(), sizes[:, 1].tolist())
    if flags & 2:
        b.at += 64 * n  # a hash of each
    out["version"] = b.column(">u4", n).tolist()
    out["subindexcount"] = [b.small_or_large() for _ in range(n)]
    out["subindices"] = [np.cumsum(b.column(">u2", k)).tolist() for k in out["subindexcount"]]
    out["subnames"] = [b.column(">u4", k).tolist() for k in out["subindexcount"]] if flags & 1 else none
    return [{"major": major, **dict(zip(out, row, strict=True))} for row in zip(*out.values(), strict=True)]


def read_root_index(data: bytes, build: int) -> list[dict]:
    """Rows of INDEX with major 255 from a root index; a crc of 0 is a hole and gives none."""
    b, rows = _Bytes(data), []
    if build >= 605:  # a count, then records that end in a checksum of 64 bytes
        n, width = int(b.column("u1", 1)[0]), 8 + (8 if build >= 816 else 0) + 64
    else:
        width = 8 if build >= 457 else 4
        n = len(data) // width
    for k in range(n):
        at = b.at + k * width
        crc, = struct.unpack_from(">I", data, at)
        version = struct.unpack_from(">I", data, at + 4)[0] if build >= 457 else 0
        count = struct.unpack_from(">I", data, at + 8)[0] if build >= 816 else 0
        if crc:
            rows.append({"major": 255, "minor": k, "name": None, "crc": crc, "version": version, "size": 0, "uncompressed_size": 0, "uncompressed_crc": 0, "subindexcount": count, "subindices": [0], "subnames": None})
    return rows


def indices(files: DataFrame, build: int) -> DataFrame:
    """Rows of INDEX, and error, from index files (major, data), decompressed; major 255 is the root index."""
    names = [f.split()[0] for f in INDEX.split(", ")]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            rows = []
            for r in b.to_pylist():
                try:
                    found = read_root_index(r["data"], build) if r["major"] == 255 else read_index(r["data"], r["major"])
                    rows += [{**x, "error": None} for x in found]
                except Exception as e:  # a bad file must not stop the others
                    rows.append({**dict.fromkeys(names), "major": r["major"], "error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(f"{INDEX}, error string"))
    return files.select("major", "data").mapInArrow(run, f"{INDEX}, error string")


# -- names --------------------------------------------------------------------------------------------


def by_name(index: DataFrame, names: DataFrame, old: bool = False) -> DataFrame:
    """name, major, minor: for each name (name; with major, of that major alone) the first minor of each major whose name has its hash."""
    hashed = names.withColumn("_hash", (legacy_name_hash if old else name_hash)(F.col("name")))
    on = ["_hash"] + (["major"] if "major" in names.columns else [])
    return hashed.join(index.select("major", "minor", F.col("name").alias("_hash")), on).groupBy("name", "major").agg(F.min("minor").alias("minor"))


def subfile_by_name(index: DataFrame, names: DataFrame, old: bool = False) -> DataFrame:
    """name, major, minor, fileid: the first file of each archive that is called name."""
    files = index.select("major", "minor", F.posexplode("subnames").alias("pos", "_hash"), "subindices").select("major", "minor", "pos", "_hash", F.get("subindices", F.col("pos")).alias("fileid"))
    hashed = names.select("name", (legacy_name_hash if old else name_hash)(F.col("name")).alias("_hash"))
    return hashed.join(files, "_hash").groupBy("name", "major", "minor").agg(F.min_by("fileid", "pos").alias("fileid"))


def any_named(index: DataFrame, names: DataFrame, old: bool = False) -> DataFrame:
    """name, major, minor of the first archive of any major that is called name."""
    found = by_name(index, names.select("name"), old)
    return found.groupBy("name").agg(F.min(F.struct("major", "minor")).alias("_at")).select("name", "_at.major", "_at.minor")


# -- SQLite containers --------------------------------------------------------------------------------


class _Range(InputPartition):
    def __init__(self, path: str, major: int, lo: int, hi: int):
        self.path, self.major, self.lo, self.hi = path, major, lo, hi


class _JcacheReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.rows, self.index = _local(options["path"]), int(options.get("rowsPerTask", 10_000)), options.get("index", "false") == "true"

    def partitions(self) -> list[InputPartition]:
        out = []
        for major, path in majors(self.folder):
            if self.index:
                out.append(_Range(path, major, 0, 0))
                continue
            with _opened(path) as db:
                lo, hi = db.execute("SELECT min(KEY), max(KEY) FROM cache").fetchone()
            out += [_Range(path, major, k, k + self.rows) for k in range(lo, hi + 1, self.rows)] if lo is not None else []
        return out

    def read(self, partition: _Range):
        with _opened(partition.path) as db:
            if self.index:
                yield from ((partition.major, None, row[0], None) for row in db.execute("SELECT DATA FROM cache_index"))
            else:
                yield from ((partition.major, *row) for row in db.execute("SELECT KEY, DATA, CRC FROM cache WHERE KEY >= ? AND KEY < ? ORDER BY KEY", (partition.lo, partition.hi)))


class JcacheSource(DataSource):
    """spark.read.format("jcache").load(folder): major, minor, data, crc of the files js5-<major>.jcache in a folder that all executors see.

    A database is read by ranges of its key, rowsPerTask (10,000) to a task. Option index=true: the index files instead.
    """

    @classmethod
    def name(cls) -> str:
        return "jcache"

    def schema(self) -> str:
        return "major int, minor int, data binary, crc long"

    def reader(self, schema) -> _JcacheReader:
        return _JcacheReader(self.options)


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


class _opened:
    """A SQLite file opened to read, or to write, and closed at the end."""

    def __init__(self, path: str, write: bool = False):
        self.db = sqlite3.connect(path) if write else sqlite3.connect(f"file:{path}?mode=ro", uri=True)

    def __enter__(self) -> sqlite3.Connection:
        return self.db

    def __exit__(self, kind, *_):
        if kind is None:
            self.db.commit()
        self.db.close()


def majors(folder: str) -> list[tuple[int, str]]:
    """(major, path) of the databases in a folder, which stand in for a root index."""
    import os

    found = ((re.fullmatch(r"js5-(\d+)\.jcache", f), f) for f in os.listdir(_local(folder)))
    return sorted((int(m[1]), os.path.join(_local(folder), f)) for m, f in found if m)


def root_index(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of INDEX with major 255: one for each database in the folder."""
    rows = [(255, m, None, 0, 0, 0, 0, 0, 1, [0], None) for m, _ in majors(folder)]
    return spark.createDataFrame(rows, INDEX)


def write_blobs(blobs: DataFrame, folder: str) -> None:
    """Replaces the blobs of existing minors (major, minor, data), compressed here; one task for each database, as SQLite has one writer."""
    folder = _local(folder)

    def write(key, pdf: pd.DataFrame) -> pd.DataFrame:
        with _opened(f"{folder}/js5-{key[0]}.jcache", True) as db:
            changed = sum(db.execute("UPDATE cache SET DATA = ? WHERE KEY = ?", (compress(bytes(d)), int(m))).rowcount for m, d in zip(pdf["minor"], pdf["data"], strict=True))
        return pd.DataFrame({"major": [key[0]], "changed": [changed]})

    blobs.groupBy("major").applyInPandas(write, "major int, changed long").collect()  # a row for each database


# -- folders, callbacks, detection --------------------------------------------------------------------


def extracted(spark: SparkSession, folder: str, major: int) -> DataFrame:
    """major, minor, data of a folder's files: the i-th by name is minor i."""
    files = spark.read.format("binaryFile").load(folder)
    names = files.select("path")  # of a folder's listing, not of its bytes
    numbered = names.withColumn("minor", F.row_number().over(Window.orderBy("path")) - 1)
    return files.select("path", F.col("content").alias("data")).join(numbered, "path").select(F.lit(major).alias("major"), F.col("minor").cast("int").alias("minor"), "data")


def from_callback(wanted: DataFrame, get: Callable[[int, int, int | None], bytes | None]) -> DataFrame:
    """wanted (major, minor, crc) with data, what the user's function gives for each; it runs on the executors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(data=[get(int(a), int(b), None if pd.isna(c) else int(c)) for a, b, c in zip(f["major"], f["minor"], f["crc"], strict=True)])

    return wanted.select("major", "minor", "crc").mapInPandas(run, "major int, minor int, crc long, data binary")


def with_cached(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """wanted (major, minor, crc) with data and state from blocks kept before: hit, missing (kept as null: known not to exist) or unknown."""
    kept = cached.select("major", "minor", "crc", "data", F.lit(True).alias("_in"))
    state = F.when(F.col("_in").isNull(), "unknown").when(F.col("data").isNull(), "missing").otherwise("hit")
    return wanted.join(kept, ["major", "minor", "crc"], "left").select("major", "minor", "crc", "data", state.alias("state"))


def file_types(paths: DataFrame) -> DataFrame:
    """extension, files: how many paths end in each extension, the most frequent first, then by name."""
    ext = F.lower(F.regexp_extract("path", r"\.([^./\\]+)$", 1))
    return paths.groupBy(ext.alias("extension")).agg(F.count("*").alias("files")).orderBy(F.desc("files"), "extension")


#: Which reader an extension stands for.
READER_OF = {"jcache": "nxt", "dat2": "dat2", "dat": "legacy", "jag": "classic", "mem": "classic"}


def detect(paths: DataFrame) -> str:
    """The reader that most files of a folder ask for; extracted if none is known."""
    top = file_types(paths).where(F.col("extension").isin(*READER_OF)).first()
    return READER_OF[top["extension"]] if top else "extracted"


def classic_versions(names: DataFrame, target: DataFrame) -> DataFrame:
    """build, group, version, complete: for each target build (group, wanted) the newest version found (name like maps63.jag) that is not above it; complete is false for builds in which a group has none."""
    found = names.select(F.regexp_extract("name", r"([A-Za-z]+)\d+\.(jag|mem)$", 1).alias("group"), F.regexp_extract("name", r"(\d+)\.(jag|mem)$", 1).try_cast("int").alias("version")).where("group <> ''").distinct()
    best = target.select("build", "group", "wanted").join(found.where("version IS NOT NULL"), "group", "left").groupBy("build", "group", "wanted").agg(F.max(F.when(F.col("version") <= F.col("wanted"), F.col("version"))).alias("version"))
    return best.select("build", "group", "version", F.min(F.col("version").isNotNull()).over(Window.partitionBy("build")).alias("complete"))


SOURCES = ("nxt", "cache", "cache-write", "extracted", "auto", "global")


def open_source(spark: SparkSession, uri: str, major: int = 0, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """major, minor, data of "kind:place": nxt, cache and cache-write read SQLite containers, extracted a folder, auto finds out, global takes a table by name.

    live and openrs2 need a network and are refused.
    """
    kind, _, place = uri.partition(":")
    if kind == "auto":
        kind = detect(spark.read.format("binaryFile").load(place).select("path"))
    if kind in ("nxt", "cache", "cache-write"):
        spark.dataSource.register(JcacheSource)
        return spark.read.format("jcache").load(place).select("major", "minor", "data")
    if kind == "extracted":
        return extracted(spark, place, major)
    if kind == "global":
        return (tables or {})[place].select("major", "minor", "data")
    raise ValueError(f"no source {kind}: one of {', '.join(SOURCES)}")
