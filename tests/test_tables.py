"""Named workbook tables, raw cells, tokens, loads, and small rules."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgermatch.functions import text
from ledgermatch.operators import audit, model, views
from ledgermatch.sources import listing, xlsx

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/package/2006/relationships"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def cell(at, value):
    if value is None:
        return ""
    if isinstance(value, tuple):  # a text without the type that would make it one
        return f'<c r="{at}"><is><t>{value[0]}</t></is></c>'
    return f'<c r="{at}" t="inlineStr"><is><t>{value}</t></is></c>'


def book(sheets, tables=()):
    """sheets: name to rows; tables: (sheet number, name, range)."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{LINKS}">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(cell(f"{chr(65 + j)}{r}", v) for j, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
            own = [(k, t) for k, t in enumerate(tables, 1) if t[0] == i]
            if own:
                links = "".join(f'<Relationship Id="t{k}" Type="{OFFICE}/table" Target="../tables/table{k}.xml"/>' for k, _ in own)
                z.writestr(f"xl/worksheets/_rels/sheet{i}.xml.rels", f'<Relationships xmlns="{LINKS}">{links}</Relationships>')
        for k, (_, name, ref) in enumerate(tables, 1):
            z.writestr(f"xl/tables/table{k}.xml", f'<table xmlns="{MAIN}" id="{k}" name="{name}" displayName="{name}" ref="{ref}"/>')
    return out.getvalue()


SHEETS = {"S": [["x", "y"], [None, "k", "v", "no"], [None, "a", "1", "no"], [None, None, None, "no"], [None, "b", None, "no"], [None, "after", "2"]], "T": [["k", "v"], ["c", "3"]]}
TABLES = [(2, "Other", "A1:B2"), (1, "Docs", "B2:C5")]


def found(content, **how):
    return [(row, cells) for row, cells, _ in xlsx.table_records(xlsx.Workbook(content), {"k", "v"}, str.lower, **how)]


def test_tables_by_name_then_first_then_sheets():
    both = book(SHEETS, TABLES)
    assert list(xlsx.Workbook(both).tables()) == [("S", "Docs", "B2:C5"), ("T", "Other", "A1:B2")]
    docs = [(3, {"k": "a", "v": "1"}), (5, {"k": "b", "v": None})]
    assert found(both) == docs and found(both, table=" dOCS ") == docs
    assert found(both, table="other") == [(2, {"k": "c", "v": "3"})]
    assert found(book({"E": [["k"]], "T": SHEETS["T"]})) == [(2, {"k": "c", "v": "3"})]
    for content, how, error in ((both, {"table": "none"}, "no table 'none'"), (book({"E": [["k"]]}), {}, "neither"), (book(SHEETS), {}, "lacks"), (book({"S": [["k", "v"], ["", ""], [" ", None]]}), {}, "no rows|neither"), (both, {"max_rows": 1}, "more than 1")):
        with pytest.raises(ValueError, match=error):
            found(content, **how)


def test_raw_text_of_wholly_empty_columns(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(book({"S": [["NIT proveedor", "Valor"], [("900",), "1"], [("901",), "2"]]}))
    (tmp_path / "b.xlsx").write_bytes(book({"S": [["NIT proveedor", "Valor"], ["900", "1"], [("901",), ("2",)]]}))
    (tmp_path / "c.xlsx").write_bytes(b"PK no")
    rows = listing.engine_rows(spark, str(tmp_path), {"nit_proveedor"}).collect()
    got = sorted((r["path"][-6:], r["row"], r["cells"]["nit_proveedor"], r["cells"]["valor"]) for r in rows if r["error"] is None)
    assert got == [("a.xlsx", 2, "900", "1"), ("a.xlsx", 3, "901", "2"), ("b.xlsx", 2, "900", "1")]
    assert len([r for r in rows if r["error"]]) == 1


def test_tokens_without_stop_words(spark):
    stop = text.stop_words(spark, "spanish")
    assert "para" in stop and "factura" not in stop
    docs = spark.createDataFrame([(1, "Servicio para la limpieza 2026, limpieza"), (2, "LIMPIEZA de aseo"), (3, None), (4, "Aseo y servicio"), (5, "otra cosa"), (6, "nada mas")], "id int, t string")
    out = {r["id"]: r["text"] for r in audit.item_tokens(docs, "id", "t", stop).collect()}
    assert out[1] == "servicio limpieza limpieza" and out[2] == "limpieza aseo" and out[4] == "aseo servicio" and not out[3] and not out[5]


def test_first_of_two_ids_and_leading_codes(spark):
    df = spark.createDataFrame([(" ", "FV-1"), ("A b", "x"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(F.lower(text.first_of(text.alnum_key, F.col("a"), F.col("b")))).collect()] == ["fv1", "ab", None]
    rows = spark.createDataFrame([(" 0112;99", " nan ", None), (";1", "x", 2)], "industry_code string, city string, n int")
    assert [tuple(r) for r in model.prepare(rows, ["industry_code", "city", "n"]).collect()] == [("0112", "?", 0.0), ("?", "x", 2.0)]


def test_invoices_of_a_client_and_load(spark):
    documents = spark.createDataFrame([(1, 1, "a", 5), (2, 1, "b", 5), (3, 2, "c", 5), (4, 1, "d", 6)], "document_id int, client_id int, key string, first_load_id int")
    invoices = spark.createDataFrame([("a", "dian:5"), ("b", "dian:5"), ("c", "dian:5"), ("d", "dian:5")], "key string, load_tag string")
    rows = spark.createDataFrame([(1, 9, "NUEVO"), (1, 9, "DUPLICADO"), (2, 9, "RECHAZADO"), (3, 9, "NUEVO"), (2, 8, "NUEVO")], "document_id int, load_id int, outcome string")
    assert sorted(r["key"] for r in views.of_client(invoices, documents, 1).collect()) == ["a", "b"]
    assert [r["key"] for r in views.in_load(invoices, documents, rows, 1, 9).collect()] == ["a"]


def test_semantic_differences(spark):
    rows = spark.createDataFrame([("1.0", "1.00", "0", "2"), (None, "1", "2", "2")], "allowanceTotal string, legacyDiscount string, chargeTotal string, legacyCharge string")
    out = views.semantic_differences(rows.select(*[F.col(c).cast("decimal(38,18)").alias(c) for c in rows.columns])).collect()
    assert [(r["discount_differs"], r["charge_differs"]) for r in out] == [(False, True), (None, False)]


def test_tokens_of_a_document_move_once(spark):
    rows = [(1, ["a", "b", "a"]), (1, ["b", "c"]), (2, ["a", "c", "d"]), (3, ["e"]), (None, ["a", "e"]), (4, None)]
    docs = spark.createDataFrame(rows, "id long, ws array<string>")
    out = audit.token_frequency_filter(docs, "id", "ws", 2, 0.7)
    assert sorted(((r["id"], r["text"], r["n"]) for r in out.collect()), key=str) == sorted([(1, "a c a", 3), (2, "a c", 2), (3, None, 0), (4, None, 0), (None, None, 0)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "min(at" not in plan
