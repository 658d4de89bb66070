"""Workbooks made here, cell by cell, and read, checked and imported."""

import os
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from tessera.sources import schema, sheets

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, tabs, shared=True):
    """tabs: name -> rows of cells (None: nothing; text, numbers, booleans)."""
    texts = []

    def cell(r, c, v):
        ref = f'{chr(65 + c)}{r + 1}'
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        if shared:
            texts.append(v)
            return f'<c r="{ref}" t="s"><v>{len(texts) - 1}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'

    with zipfile.ZipFile(path, "w") as z:
        for k, rows in enumerate(tabs.values()):
            body = "".join(f'<row r="{r + 1}">{"".join(cell(r, c, v) for c, v in enumerate(row))}</row>' for r, row in enumerate(rows))
            z.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>")
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{k + 1}" r:id="r{k}"/>' for k, n in enumerate(tabs))
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(len(tabs)))
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        if texts:
            z.writestr("xl/sharedStrings.xml", f'<sst {NS}>{"".join(f"<si><t>{escape(t)}</t></si>" for t in texts)}</sst>')
    return str(path)


LODESTONES = [
    [" ID ", "Lodestone", "dest_x", "dest_y", "Dest_Plane", "cost", "next_node_type", "requirements", "ignored", None],
    [1, "A", 10, 20.0, True, "7.5", " NPC ", " 1 ; 2", "x", None],
    [None, "new", "oops", -2.5, "no", None, None, 3, None, None],
    [None, None, None, None, None, None, None, None, "only this", None],
    [1, "A again", 11, None, None, None, None, None, None, None],
]


@pytest.mark.parametrize("shared", [True, False])
def test_rows_and_coercion(spark, tmp_path, shared):
    cells = sheets.cells(spark, workbook(tmp_path / "w.xlsx", {"teleports_lodestone_nodes": LODESTONES, "Other & more": [["a"]]}, shared))
    assert sorted({r.sheet for r in cells.collect()}) == ["Other & more", "teleports_lodestone_nodes"]
    got = [r.asDict() for r in sheets.rows(cells, "teleports_lodestone_nodes", schema.TABLES["teleports_lodestone_nodes"]).orderBy("row").collect()]
    assert [g["row"] for g in got] == [1, 2, 4]
    assert (got[0]["id"], got[0]["dest_x"], got[0]["dest_y"], got[0]["dest_plane"], got[0]["cost"], got[0]["next_node_type"], got[0]["_unparsed"]) == (1, 10, 20, 1, 8, "NPC", [])
    assert (got[1]["id"], got[1]["dest_x"], got[1]["dest_y"], got[1]["dest_plane"], got[1]["requirements"], got[1]["_unparsed"]) == (None, None, -3, 0, "3", ["dest_x"])
    assert "ignored" not in got[0] and sheets.rows(cells, "Other & more", schema.TABLES["tiles"]).columns == []


def test_import_is_all_or_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}/db"
    os.makedirs(tmp_path / "db")
    first = workbook(tmp_path / "a.xlsx", {"teleports_lodestone_nodes": LODESTONES, "notes": [["x"], [1]], "teleports_requirements": [["id", "key", "comparison"], [5, "level", ">="]]})
    dry = sheets.import_workbook(spark, first, folder, schema.TABLES, dry_run=True)
    assert dry.rows == {"teleports_lodestone_nodes": 3, "teleports_requirements": 1} and dry.skipped == ["notes"] and dry.total == 4 and len(dry.shown["teleports_lodestone_nodes"]) == 3 and os.listdir(tmp_path / "db") == []
    sheets.import_workbook(spark, first, folder, schema.TABLES)
    read = lambda t: {r.id: r for r in spark.read.parquet(f"{folder}/{t}").collect()}
    lode = read("teleports_lodestone_nodes")
    # the second row with id 1 replaces the columns of the sheet, so what it leaves empty is empty
    assert (lode[1].lodestone, lode[1].dest_x, lode[1].dest_y) == ("A again", 11, None) and (lode[2].lodestone, lode[2].requirements) == ("new", "3")
    bad = workbook(tmp_path / "b.xlsx", {"teleports_lodestone_nodes": [["id", "lodestone"], [1, "B"]], "teleports_item_nodes": [["id", "next_node_type"], [3, "nowhere"]]})
    with pytest.raises(ValueError, match="nowhere"):
        sheets.import_workbook(spark, bad, folder, schema.TABLES)
    assert read("teleports_lodestone_nodes")[1].lodestone == "A again" and sorted(os.listdir(tmp_path / "db")) == ["teleports_lodestone_nodes", "teleports_requirements"]
    some = workbook(tmp_path / "c.xlsx", {"teleports_lodestone_nodes": [["id", "cost"], [1, 99], [9, 1]], "teleports_requirements": [["id"], [6]]})
    sheets.import_workbook(spark, some, folder, schema.TABLES, only=["teleports_lodestone_nodes"])
    lode = read("teleports_lodestone_nodes")
    assert (lode[1].lodestone, lode[1].cost, lode[9].cost, set(read("teleports_requirements"))) == ("A again", 99, 1, {5})
    sheets.import_workbook(spark, some, folder, schema.TABLES, truncate=True)
    assert {k: r.lodestone for k, r in read("teleports_lodestone_nodes").items()} == {1: None, 9: None} and set(read("teleports_requirements")) == {6}


def test_checks_and_order(spark):
    rows = spark.createDataFrame([(1, "in", " Object ", "~"), (2, "sideways", "x", "<"), (3, None, None, None)], "row int, direction string, next_node_type string, comparison string")
    found = lambda t: sorted((r.row, r.column) for r in sheets.violations(rows, t).collect())
    assert found("door_nodes") == [(2, "direction"), (2, "next_node_type")] and found("requirements") == [(1, "comparison"), (2, "next_node_type")]
    assert found("teleports_door_nodes") == [(2, "next_node_type")]
    assert [r.direction for r in sheets.normalise(rows, "door_nodes").orderBy("row").collect()] == ["IN", "SIDEWAYS", None]
    assert sheets.sheet_order(["b", "Requirements", "a", "teleports_requirements"]) == ["Requirements", "b", "a", "teleports_requirements"]
    old = spark.createDataFrame([(1, "x")], "id int, v string")
    assert [tuple(r) for r in sheets.upsert(old, spark.createDataFrame([(1, 1), (2, 2)], "id int, row int"), "id", "row").orderBy("id").collect()] == [(1, "x"), (2, None)]
    assert spark.range(1).select(sheets.header(F.lit("  ")).alias("a"), sheets.header(F.lit(" b ")).alias("b")).first().asDict() == {"a": None, "b": "b"}


def test_tables_views_and_copies(spark, tmp_path):
    spark.conf.set("spark.sql.legacy.createHiveTableByDefault", "false")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS one LOCATION 'file://{tmp_path}/one'")
    try:
        assert not schema.has_tables(spark, "one") and not schema.has_tables(spark, "nowhere")
        schema.create_tables(spark, "one")
        with pytest.raises(ValueError):
            schema.create_tables(spark, "one")
        assert schema.describe(spark, "one").keys() == schema.TABLES.keys() and spark.table("one.teleports_all").count() == 0
        assert [c.name for c in spark.catalog.listColumns("one.tiles") if c.isPartition] == ["RegionID"]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS two LOCATION 'file://{tmp_path}/two'")
        assert schema.copy_tables(spark, "one", "two") == sorted(set(schema.TABLES) - {"tiles"}) and schema.copy_views(spark, "one", "two") == ["teleports_all"]
        assert spark.table("two.teleports_all").count() == 0 and not spark.catalog.tableExists("two.tiles")
    finally:
        for d in ("one", "two"):
            spark.sql(f"DROP DATABASE IF EXISTS {d} CASCADE")
