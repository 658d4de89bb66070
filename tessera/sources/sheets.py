"""Spreadsheets into typed tables: reading, coercion of cells, checks, upserts, all sheets or none.

A workbook is read in one task, as one zip file; what comes out is a DataFrame for each sheet and the rest is declared on that.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from tessera.functions import text

# -- addresses ----------------------------------------------------------------------------------------


def is_sheet_url(url: Column) -> Column:
    """Whether an address is that of an online spreadsheet."""
    return F.coalesce(url.rlike(r"^https?://") & F.contains(url, F.lit("docs.google.com")) & F.contains(url, F.lit("/spreadsheets/")), F.lit(False))


def export_url(url: Column) -> Column:
    """The address that gives a spreadsheet as a workbook; its page (gid) is kept. Null without a document id after /d/."""
    doc, page = F.regexp_extract(url, r"/d/([^/?#]+)", 1), F.regexp_extract(url, r"[?&#]gid=(\d+)", 1)
    made = F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), doc, F.lit("/export?format=xlsx"), F.when(page != "", F.concat(F.lit("&gid="), page)).otherwise(""))
    return F.when(doc != "", made)


# -- workbooks ----------------------------------------------------------------------------------------

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def _column(ref: str) -> int:
    """Number of the column of a cell like AB12, from 0."""
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _cells(xml: bytes, shared: list[str]) -> Iterator[tuple[int, int, str, str]]:
    """(row, column, kind, value) of the cells that hold something; kinds: n number, s text, b boolean."""
    row = -1
    for r in ElementTree.fromstring(xml).iter(f"{{{_NS['m']}}}row"):
        row = int(r.get("r", row + 2)) - 1
        column = -1
        for c in r.iter(f"{{{_NS['m']}}}c"):
            column = _column(c.get("r")) if c.get("r") else column + 1
            kind, v = c.get("t", "n"), c.find("m:v", _NS)
            if kind == "inlineStr":
                yield row, column, "s", _texts(c)
            elif v is not None and v.text is not None:
                if kind == "s":
                    yield row, column, "s", shared[int(v.text)]
                elif kind in ("b", "n"):
                    yield row, column, kind, v.text
                elif kind == "str":
                    yield row, column, "s", v.text


def read_workbook(data: bytes) -> Iterator[tuple[str, int, int, str, str]]:
    """(sheet, row, column, kind, value) of all cells, sheet by sheet."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = [_texts(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)] if "xl/sharedStrings.xml" in names else []
        target = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet"):
            path = target[s.get(f"{{{_NS['r']}}}id")].lstrip("/")
            for cell in _cells(z.read(path if path.startswith("xl/") else f"xl/{path}"), shared):
                yield (s.get("name"), *cell)


def cells(spark: SparkSession, path: str) -> DataFrame:
    """sheet, row, col, kind, value of the workbooks at path."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                yield pd.DataFrame(read_workbook(bytes(content)), columns=["sheet", "row", "col", "kind", "value"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "sheet string, row int, col int, kind string, value string")


def header(value: Column) -> Column:
    """A header's text, null if there is nothing in it."""
    return F.nullif(F.trim(value), F.lit(""))


def coerce(kind: Column, value: Column, integer: bool) -> Column:
    """A cell as text, as a column of integers or text takes it: booleans and their words are 0 or 1 there, numbers are rounded half away from zero; text that is no number stays as it is."""
    t = F.trim(value)
    if not integer:
        number = value.try_cast("double")
        plain = F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(number.cast("string"))
        return F.when(kind == "b", F.when(value == "1", "true").otherwise("false")).when(kind == "n", F.coalesce(plain, t)).when(t != "", t)
    n = text.to_integer(F.when(kind == "b", F.when(value == "1", "true").otherwise("false")).otherwise(t))
    return F.when(t != "", F.coalesce(n.cast("string"), t))


def rows(cells_: DataFrame, sheet: str, schema: StructType) -> DataFrame:
    """Rows of a sheet in the types of schema, by the headers of its first row, whatever their case; other columns, and rows with nothing, are left out.

    Columns of the schema that the sheet lacks are left out too. Text in an integer column that is no number is null, and listed in _unparsed.
    """
    own = cells_.where(F.col("sheet") == sheet)
    known = {f.name.lower(): f for f in schema.fields}
    heads = [(r["col"], r["name"]) for r in own.where("row = 0").select("col", F.lower(header(F.col("value"))).alias("name")).collect()]  # one row of a sheet
    given = [(c, known[n]) for c, n in sorted(heads) if n in known]
    if not given:
        return cells_.sparkSession.createDataFrame([], StructType([]))
    at = lambda c: F.struct("kind", "value")  # noqa: E731, ARG005
    wide = own.where("row > 0").groupBy("row").agg(*(F.max(F.when(F.col("col") == c, at(c))).alias(f"_c{c}") for c, _ in given))
    out, bad = [], []
    for c, f in given:
        integer = isinstance(f.dataType, IntegralType)
        v = coerce(F.col(f"_c{c}.kind"), F.col(f"_c{c}.value"), integer)
        out.append(v.try_cast(f.dataType).alias(f.name))
        if integer:
            bad.append(F.when(v.isNotNull() & v.try_cast(f.dataType).isNull(), F.lit(f.name)))
    some = F.coalesce(*(c.cast("string") for c in (coerce(F.col(f"_c{c}.kind"), F.col(f"_c{c}.value"), isinstance(f.dataType, IntegralType)) for c, f in given)))
    return wide.where(some.isNotNull()).select("row", *out, (F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")).alias("_unparsed"))


# -- checks -------------------------------------------------------------------------------------------

# fixed values: what a column may hold
NODE_TYPES = ("object", "npc", "ifslot", "door", "lodestone", "item", "fairy_rings", "fairy_ring")
COMPARISONS = ("=", "!=", "<", "<=", ">", ">=")
DIRECTIONS = ("IN", "OUT")


def normalise(df: DataFrame, table: str) -> DataFrame:
    """next_node_type in lower case without blanks, requirements as a list of digits; the direction of doors in upper case, of a table named door_nodes alone."""
    has, out = set(df.columns), df
    if table.lower() == "door_nodes" and "direction" in has:
        out = out.withColumn("direction", F.upper(F.trim("direction")))
    if "next_node_type" in has:
        out = out.withColumn("next_node_type", F.lower(F.trim("next_node_type")))
    if "requirements" in has:
        out = out.withColumn("requirements", text.requirement_list(F.col("requirements").cast("string")))
    return out


def violations(df: DataFrame, table: str, node_types=NODE_TYPES) -> DataFrame:
    """row, column, value of cells that may not hold what they do."""
    rules = []
    if table.lower() == "door_nodes":
        rules.append(("direction", F.upper(F.trim("direction")).isin(*DIRECTIONS)))
    rules.append(("next_node_type", F.lower(F.trim("next_node_type")).isin(*node_types)))
    if table.lower() == "requirements":
        rules.append(("comparison", F.col("comparison").isin(*COMPARISONS)))
    found = [F.when(F.col(c).isNotNull() & ~ok, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c, ok in rules if c in df.columns]
    return df.select("row", F.explode(F.array_compact(F.array(*found)))).select("row", "col.column", "col.value") if found else df.sparkSession.createDataFrame([], "row int, column string, value string")


def meets(value: Column, comparison: Column, wanted: Column) -> Column:
    """value comparison wanted, the comparison being data; null for one that isn't known."""
    out = F.lit(None).cast("boolean")
    for name, test in (("=", value == wanted), ("!=", value != wanted), ("<", value < wanted), ("<=", value <= wanted), (">", value > wanted), (">=", value >= wanted)):
        out = F.when(comparison == name, test).otherwise(out)
    return out


# -- upserts ------------------------------------------------------------------------------------------


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """old with new's rows in it, one after the other by order: those with a key replace the columns that new has, null included, or are added; those without one get the next numbers.

    If new has no column but the key, known keys stay as they are.
    """
    given = [c for c in new.columns if c not in (key, order) and c in old.columns]
    keyed = new.where(F.col(key).isNotNull())
    last = keyed.groupBy(key).agg(F.max_by(F.struct(*given), order).alias("_n")) if given else keyed.select(key).distinct().withColumn("_n", F.lit(None))
    last = last.withColumn("_in", F.lit(True))
    value = lambda c: F.when(F.col("_in"), F.col(f"_n.{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
    both = old.join(last, key, "full").select(*(F.col(key) if c == key else value(c) for c in old.columns))
    free = new.where(F.col(key).isNull())
    top = both.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))  # one row
    numbered = free.withColumn("_k", F.row_number().over(Window.orderBy(order))).join(F.broadcast(top))  # rows of one sheet
    kind = old.schema[key].dataType
    added = numbered.select(*((F.col("_top") + F.col("_k")).cast(kind).alias(c) if c == key else F.col(c).cast(old.schema[c].dataType).alias(c) if c in given else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns))
    return both.unionByName(added)


@dataclass
class Report:
    """What an import did: rows by sheet, sheets that no table is named after, and the first rows of a dry run."""

    rows: dict[str, int] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    shown: dict[str, list] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return sum(self.rows.values())


def sheet_order(names: list[str]) -> list[str]:
    """A sheet that is called requirements comes first; the others keep their order."""
    return sorted(names, key=lambda n: n.lower() != "requirements")


def import_workbook(spark: SparkSession, path: str, folder: str, tables: dict[str, StructType], only: list[str] | None = None, truncate: bool = False, dry_run: bool = False, key: str = "id") -> Report:
    """Upserts the sheets of a workbook into the Parquet tables folder/<name>: all of them, or, if any row is refused, none.

    Each table is written beside the old one; when all are, they are swapped in. dry_run writes nothing and shows five rows a sheet.
    """
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = jvm(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, report, staged = cells(spark, path).persist(), Report(), []
    by_name = {t.lower(): t for t in tables}
    try:
        names = [r["sheet"] for r in found.groupBy("sheet").agg(F.count("*")).collect()]  # of one workbook
        for sheet in sheet_order(sorted(n for n in names if only is None or n in only)):
            table = by_name.get(sheet.lower())
            if table is None:
                report.skipped.append(sheet)
                continue
            new = rows(found, sheet, tables[table])
            bad = violations(new, table).limit(1).collect() if new.columns else []
            if bad:
                raise ValueError(f"{sheet}, row {bad[0]['row'] + 1}: {bad[0]['column']} may not be {bad[0]['value']}")
            new = normalise(new.drop("_unparsed"), table) if new.columns else new
            report.rows[table] = new.count() if new.columns else 0
            if dry_run:
                report.shown[table] = new.orderBy("row").limit(5).collect() if new.columns else []
                continue
            place = f"{folder}/{table}"
            old = spark.read.schema(tables[table]).parquet(place) if not truncate and fs.exists(jvm(place)) else spark.createDataFrame([], tables[table])
            stage = f"{folder}/.stage-{uuid.uuid4().hex}-{table}"
            (upsert(old, new, key, "row") if new.columns else old).write.parquet(stage)
            staged.append((stage, place))
    except Exception:
        for stage, _ in staged:
            fs.delete(jvm(stage), True)
        raise
    finally:
        found.unpersist()
    for stage, place in staged:
        kept = f"{place}.old-{uuid.uuid4().hex}"
        if fs.exists(jvm(place)):
            fs.rename(jvm(place), jvm(kept))
        fs.rename(jvm(stage), jvm(place))
        fs.delete(jvm(kept), True)
    return report
