"""Workbooks without a library for them, the growing dimension, and markers of single days."""

import io
import zipfile
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velora.functions.dates import kst_cutoff, stamped
from velora.operators import promotion
from velora.operators.dimension import GrowingDimension
from velora.operators.quality import Check, QualityError
from velora.plans.services import workbook
from velora.sources import files, xlsx
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def book(sheet, shared="", styles=None, date1904=False, target="worksheets/s.xml"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS}>{"<workbookPr date1904=" + chr(34) + "1" + chr(34) + "/>" if date1904 else ""}<sheets><sheet name="a" sheetId="1" r:id="x"/><sheet name="b" sheetId="2" r:id="y"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="y" Target="worksheets/other.xml"/><Relationship Id="x" Target="{target}"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {NS}><sheetData>{sheet}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{shared}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {NS}>{styles}</styleSheet>")
    return out.getvalue()


def test_cells():
    """Every kind of cell, skipped columns and rows, formulas, rich texts with readings, and dates by style."""
    styles = '<numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="171" formatCode="[Red]0.0&quot; days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    shared = "<si><t>name</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>reading</t></rPh></si><si><t></t></si>"
    sheet = """<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>in line</t></is></c></row>
    <row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3"><v>20260821</v></c><c r="C3"><v>0.1</v></c><c r="D3"><v>5.0</v></c><c r="E3" t="b"><v>1</v></c><c r="F3" t="e"><v>#DIV/0!</v></c><c r="G3" t="str"><f>A1</f><v>of a formula</v></c></row>
    <row r="4"><c r="A4" t="s"><v>2</v></c></row>
    <row r="5"><c r="AA5" s="1"><v>46255.5</v></c><c r="AB5" s="2"><v>59</v></c><c r="AC5" s="3"><v>2</v></c><c r="AD5" t="str"><v>N/A</v></c></row><row r="9"><c r="A9"/></row>"""
    rows = list(xlsx.sheet_rows(book(sheet, shared, styles)))
    assert rows[:4] == [["name", "", "in line"], [], ["rich text", "20260821", "0.1", "5", "True", "", "of a formula"], []]
    assert rows[4][26:] == ["2026-08-21 12:00:00", "1900-02-28 00:00:00", "2", ""] and len(rows) == 5
    late = list(xlsx.sheet_rows(book('<row><c s="1"><v>0</v></c></row>', styles=styles, date1904=True, target="/xl/worksheets/s.xml")))
    assert late == [["1904-01-01 00:00:00"]]
    assert list(xlsx.sheet_rows(book(""))) == []
    assert xlsx.header_names(["a", "", "a", "b", "a"]) == ["a", "Unnamed: 1", "a.1", "b", "a.2"]


def test_workbook_equals_the_csv_of_its_rows(spark, tmp_path):
    header = ["id", "이름", "note"]
    rows = [[i, f"name {i} <&>", None if i % 3 else "x, \"y\""] for i in range(12_000)]
    (tmp_path / "a.xlsx").write_bytes(workbook(header, rows))
    spark.createDataFrame(rows, "id long, `이름` string, note string").coalesce(1).write.option("header", True).option("escape", '"').csv(f"file://{tmp_path}/csv")
    want = sorted(tuple(r) for r in spark.read.option("header", True).option("escape", '"').csv(f"file://{tmp_path}/csv").na.fill("").collect())
    got = xlsx.read_xlsx(spark, f"file://{tmp_path}/*.xlsx")
    assert got.columns == header and sorted(tuple(r) for r in got.collect()) == want


def test_workbooks_with_different_columns(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook(["k", "v"], [["1", "x"]]))
    (tmp_path / "b.xlsx").write_bytes(workbook(["w", "k"], [["y", "2"], [None, None], ["z", None]]))
    (tmp_path / "c.xlsx").write_bytes(workbook(["k"], []))
    assert files.archive_members((tmp_path / "a.xlsx").read_bytes()) == []
    got = xlsx.read_xlsx(spark, f"file://{tmp_path}/*.xlsx")
    assert got.columns == ["k", "v", "w"] and sorted(tuple(r) for r in got.collect()) == [("", "", ""), ("", "", "z"), ("1", "x", ""), ("2", "", "y")]


# the growing dimension

BIKES = StructType().add("bike_id", "string").add("first", "timestamp_ntz").add("day", "string")


def seen(spark, *rows):
    return spark.createDataFrame([(b, None if d is None else datetime(2026, 1, d, h), None if d is None else f"2026-01-{d:02}") for b, d, h in rows], BIKES)


def dimension(spark, tmp_path, **more):
    return GrowingDimension(Table(spark, f"file://{tmp_path}/bikes", BIKES, "day"), "bike_id", Check("bikes").complete("bike_id").uniqueness(["bike_id"]), **more)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 22])
def test_growth(spark, tmp_path, bits):
    """A full filter sends every key the exact way; the rows are the same."""
    d = dimension(spark, tmp_path, bits=bits)
    many = [(f"m{i}", 1 + i % 3, 5) for i in range(3000 if bits == 1 << 15 else 50)]
    assert d.grow(seen(spark, ("a", 1, 9), ("a", 1, 8), ("b", 2, 1), (None, 1, 1), ("n", None, 0), *many)) == 2 + len(many)
    assert d.grow(seen(spark, ("a", 3, 1), ("c", 2, 7), ("b", 1, 1), ("n", 4, 1))) == 2  # late for day 2, whose rows stay
    assert d.grow(seen(spark, ("a", 1, 1), ("c", 5, 5))) == 0
    got = {r.bike_id: (r.first.day, r.first.hour, r.day) for r in d.table.read().collect()}
    assert len(got) == 4 + len(many) and got["a"] == (1, 8, "2026-01-01") and got["c"] == (2, 7, "2026-01-02") and got["n"][0] == 4 and got["m1"][2] == "2026-01-02"


def test_filter_keeps_new_keys_from_the_join(spark, tmp_path):
    d = dimension(spark, tmp_path)
    d.grow(seen(spark, *((f"k{i}", 1 + i % 4, 1) for i in range(500))))
    asked = spark.createDataFrame([(f"k{i}",) for i in range(1000)], "bike_id string")
    got = {r.bike_id: r["__maybe"] for r in d.maybe_known(asked).collect()}
    assert all(got[f"k{i}"] for i in range(500)) and sum(got[f"k{i}"] for i in range(500, 1000)) < 5


def test_a_run_that_stops_between_filter_and_rows(spark, tmp_path, monkeypatch):
    d = dimension(spark, tmp_path)
    real = Table.replace_partitions
    monkeypatch.setattr(Table, "replace_partitions", lambda self, *a: real(self, *a) if self is d.filters else (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        d.grow(seen(spark, ("a", 1, 1)))
    monkeypatch.undo()
    assert d.grow(seen(spark, ("a", 1, 1))) == 1 and d.table.read().count() == 1


def test_the_whole_table_is_checked_after_the_write(spark, tmp_path):
    d = dimension(spark, tmp_path)
    d.table.append(seen(spark, ("x", 1, 1), ("x", 2, 1)))
    with pytest.raises(QualityError):
        d.grow(seen(spark, ("y", 3, 1)))
    assert d.table.read().where("bike_id = 'y'").count() == 1


# single days


def test_a_missed_day_is_marked_however_it_ends(spark, tmp_path):
    schema = StructType().add("day", "date").add("v", "integer")
    t, store = Table(spark, f"file://{tmp_path}/t", schema, "day"), ObjectStore(spark, f"file://{tmp_path}/s")
    at, mark = datetime(2026, 1, 9), lambda d: store.get_json(promotion.marker_key("reports", d))
    rows = lambda *v: lambda: spark.createDataFrame([(x,) for x in v], "v integer")
    assert promotion.catch_up_day(t, rows(1, 2), store, "reports", date(2026, 1, 1), at) == "COMPLETE" and mark(date(2026, 1, 1))["rows"] == 2
    assert promotion.catch_up_day(t, rows(), store, "reports", date(2026, 1, 2), at) == "COMPLETE_EMPTY"

    def broken():
        raise OSError("the service is down")

    with pytest.raises(OSError):
        promotion.catch_up_day(t, broken, store, "reports", date(2026, 1, 1), at)
    assert mark(date(2026, 1, 1))["status"] == "FAILED" and mark(date(2026, 1, 1))["error"] == "the service is down" and t.read().count() == 2
    assert promotion.finished_days(store, "reports") == [date(2026, 1, 2)]


def test_now(spark):
    now = datetime.now(timezone.utc)
    assert all(abs(kst_cutoff(v) - now) < timedelta(minutes=1) and kst_cutoff(v).microsecond == 0 for v in (None, ""))
    got = stamped(spark.range(5)).select(F.countDistinct("ingested_at"), F.max("ingested_at")).first()
    assert got[0] == 1 and got[1] is not None
