import io
import zipfile

import pytest

from ledgermatch.sources import ubl, xlsx

ROW = '<row r="{r}">{cells}</row>'


def workbook(rows, extra=None):
    """A small workbook with one sheet of inline strings and numbers."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    body = "".join(
        f'<row r="{i}">' + "".join(f'<c r="{chr(65 + j)}{i}"' + (f' s="{v[1]}"><v>{v[0]}</v></c>' if isinstance(v, tuple) else f' t="inlineStr"><is><t>{v}</t></is></c>') for j, v in enumerate(row) if v is not None) + "</row>" for i, row in enumerate(rows, 1)
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="164" formatCode="00000000"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["title"], ["Código", "FECHA", "Valor"], ["x", (46081, 1), (1.5, 0)], [None], ["y", None, (248, 2)]]))
    (tmp_path / "b.xlsx").write_bytes(workbook([["nothing"]]))
    (tmp_path / "c.xlsx").write_bytes(b"no zip")
    out = xlsx.read_workbooks(spark, str(tmp_path), ["CODIGO", "VALOR", "FECHA"]).collect()
    good = [(r["row"], r["CODIGO"], r["VALOR"], r["FECHA"]) for r in out if r["error"] is None]
    assert sorted(good) == [(3, "x", "1.5", "2026-02-28"), (5, "y", "00000248", None)]
    assert sorted(r["error"] for r in out if r["error"]) == ["no sheet has the required columns", "not a workbook"]


def test_workbook_limits():
    book = xlsx.Workbook(workbook([["A"], ["1"], ["2"]]))
    with pytest.raises(ValueError, match="more than 1"):
        list(xlsx.read_sheet(book, ["A"], max_rows=1))
    with pytest.raises(ValueError, match="twice"):
        list(xlsx.read_sheet(xlsx.Workbook(workbook([["A", "a"], ["1"]])), ["A"]))
    with pytest.raises(ValueError, match="no rows"):
        list(xlsx.read_sheet(xlsx.Workbook(workbook([["A"]])), ["A"]))
    with pytest.raises(ValueError, match="no sheet 'X'"):
        list(xlsx.read_sheet(book, ["A"], sheet="X"))
    with pytest.raises(ValueError, match="too large"):
        xlsx.Workbook(workbook([["A"]]), max_unzipped=10)
    assert xlsx.column_number("AA3") == 26


def document(lines=1, root="Invoice", extra="", count=None, payable="119.00", currency="COP", key="a" * 96, line_currency="COP", amount="100.00"):
    line = f'<cac:{root}Line><cbc:ID>1</cbc:ID><cbc:{"Invoiced" if root == "Invoice" else "Credited"}Quantity>1</cbc:{"Invoiced" if root == "Invoice" else "Credited"}Quantity><cbc:LineExtensionAmount currencyID="{line_currency}">{amount}</cbc:LineExtensionAmount><cac:Item><cbc:Description>Café</cbc:Description></cac:Item></cac:{root}Line>'
    tax = '<cac:TaxTotal><cbc:TaxAmount currencyID="COP">19.00</cbc:TaxAmount><cac:TaxSubtotal><cbc:TaxAmount currencyID="COP">19.00</cbc:TaxAmount><cac:TaxCategory><cac:TaxScheme><cbc:ID>01</cbc:ID></cac:TaxScheme></cac:TaxCategory></cac:TaxSubtotal></cac:TaxTotal>'
    return f"""{extra}<{root} xmlns="{ubl.UBL}{root}-2" xmlns:cac="{ubl.CAC[1:-1]}" xmlns:cbc="{ubl.CBC[1:-1]}"><cbc:ID>FV1</cbc:ID><cbc:UUID>{key}</cbc:UUID><cbc:IssueDate>2026-01-02</cbc:IssueDate>
<cbc:LineCountNumeric>{lines if count is None else count}</cbc:LineCountNumeric><cac:AccountingSupplierParty><cac:Party><cac:PartyTaxScheme><cbc:CompanyID>900</cbc:CompanyID></cac:PartyTaxScheme><cac:PartyName><cbc:Name>N</cbc:Name></cac:PartyName></cac:Party></cac:AccountingSupplierParty><cac:AccountingCustomerParty><cac:Party><cac:PartyTaxScheme><cbc:CompanyID>901</cbc:CompanyID><cbc:RegistrationName>C</cbc:RegistrationName></cac:PartyTaxScheme></cac:Party></cac:AccountingCustomerParty>
{tax}<cac:LegalMonetaryTotal><cbc:PayableAmount currencyID="{currency}">{payable}</cbc:PayableAmount></cac:LegalMonetaryTotal>{line * lines}</{root}>"""


def test_ubl(spark):
    cases = {
        "ok": (document(), None), "credit": (document(root="CreditNote"), None), "two lines": (document(2), None),
        "dtd": (document(extra="<!DOCTYPE a>"), "DTD is not allowed"), "count": (document(count=2), "other number of lines"), "none": (document(0), "no lines"), "root": ("<a/>", "other root"), "broken": ("<a>", "not well formed"), "null": (None, "not well formed"),
        "nan": (document(payable="NaN"), "amount out of range"), "big": (document(payable="1" + "0" * 20), "amount out of range"), "places": (document(amount="0." + "1" * 19), "amount has too many decimals"), "currency": (document(line_currency="USD"), "two currencies"), "key": (document(key="x"), "key is not 96 hex digits"),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "path string, content string")
    out = {r["path"]: r for r in ubl.parse(df).collect()}
    assert {k: r["error"] for k, r in out.items()} == {k: v[1] for k, v in cases.items()}
    header = out["ok"]["header"]
    assert (header["iva_total"], header["payable"], header["supplier_nit"], header["supplier_name"], header["inc_total"]) == ("19.00", "119.00", "900", "N", None)
    assert out["two lines"]["lines"][1]["ordinal"] == 2 and out["ok"]["lines"][0]["description"] == "Café"
    items = ubl.item_texts(ubl.parse(df.where("path = 'ok'"))).first()
    assert items["descriptions"] == "Café" and items["codes"] == ""


def test_verified_read(spark, tmp_path):
    import hashlib

    (tmp_path / "x.xml").write_bytes(b"<a/>")
    path = f"file:{tmp_path}/x.xml"
    good = spark.createDataFrame([(path, 4, hashlib.sha256(b"<a/>").hexdigest())], "path string, size long, sha256 string")
    assert ubl.read_verified(spark, str(tmp_path), good).count() == 1
    assert ubl.read_verified(spark, str(tmp_path), good.replace(4, 5, "size")).count() == 0


def test_listing_and_ledger_rows(spark, tmp_path):
    from datetime import date, datetime
    from decimal import Decimal

    from ledgermatch.sources import listing

    head = ["Tipo de documento", "CUFE/CUDE", "Folio", "Fecha Emisi�n", "Fecha Recepción", "NIT Emisor", "Nombre Emisor", "NIT Receptor", "Nombre Receptor", "IVA", "Total", "Estado", "Grupo", "Otra"]
    good = ["Factura", "AB" * 48, "7", "28-09-2026", "28-09-2026 10:11:12", "900", "E", "800", "R", "16.822,50", "100", "Ok", "g", "kept"]
    bad = ["Application response", "x", "8", "31-02-2026", "", "900", "E", "800", "R", "", "abc", "Ok", "g", None]
    (tmp_path / "l.xlsx").write_bytes(workbook([head, good, bad]))
    rows = {r["folio"]: r for r in listing.listing_rows(spark, str(tmp_path / "l.xlsx")).collect()}
    one, two = rows["7"], rows["8"]
    assert (one["iva"], one["total"], one["fecha_emision"], one["fecha_recepcion"], one["key_type"], one["ica"]) == (Decimal("16822.5"), Decimal(100), date(2026, 9, 28), datetime(2026, 9, 28, 10, 11, 12), "CUFE", Decimal(0))
    assert one["parse_errors"] == "" and len(one["content_hash"]) == 64 and '"Otra":"kept"' in one["original_json"] and one["cufe_cude"] == "ab" * 48
    assert two["key_type"] == "CUDE" and two["content_hash"] == "" and two["parse_errors"] == "fecha emision no es valido; total no es valido"
    assert listing.without_responses(listing.listing_rows(spark, str(tmp_path / "l.xlsx"))).count() == 1

    columns = ["Fecha", "Documento", "Tipo Doc", "Num Doc", "Cuenta", "Naturaleza", "Débito", "Crédito", "Identidad Tercero", "Ind Contabilidad"]
    ledger = [columns, ["2026/02/28", "d", "FC", "00000248", "51", "D", "10.5", "0", "9", "k1"], ["2026-02-28", "d", "FC", "1", "51", "X", "1", "0", "9", "k2"], ["2026-02-28", "d", "FC", "1", "51", "C", "0", "1.12345", "9", "k3"], ["x", "d", "FC", "1", "51", "C", "0", "1", "9", None]]
    (tmp_path / "m.xlsx").write_bytes(workbook([["banner"], *ledger]))
    out = {r["row"]: r for r in listing.ledger_rows(spark, str(tmp_path / "m.xlsx")).collect()}
    assert [out[i]["rule"] for i in (3, 4, 5, 6)] == [None, "Naturaleza debe ser D o C.", "Debito o Credito tienen mas de 4 decimales significativos.", "IndContabilidad obligatorio o demasiado largo."]
    assert out[3]["fecha"] == date(2026, 2, 28) and out[3]["numdoc"] == "00000248" and out[3]["debito"] == Decimal("10.5") and len(out[3]["content_hash"]) == 64


def test_sinks(spark, tmp_path):
    from datetime import datetime

    from pyspark.sql import functions as F

    from ledgermatch.sources import sinks

    a = spark.createDataFrame([("x", "A"), ("y", "A")], "k string, state string")
    b = spark.createDataFrame([("x", "A"), ("y", "B"), ("z", "A")], "k string, state string")
    now = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    assert sorted((r["k"], r["from_state"], r["to_state"]) for r in sinks.status_history(a, b, "k", now).collect()) == [("y", "A", "B"), ("z", None, "A")]
    assert tuple(sinks.outbox(b.where("k = 'x'"), ["k"], 60, now).first()) == ('{"schemaVersion":1,"k":"x"}', datetime(2026, 1, 1, 0, 1))
    sinks.report(b.withColumn("l", F.array("k")), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).where("k = 'x'").first()["l"] == '["x"]'


def test_item_texts_parse_once_and_keep_header_columns(spark):
    lines = [(1, 2, 9.0, 1.0, n) for n in (1, 2)] + [(2, 10, 5.0, 1.0, 1), (2, 9, 5.0, 1.0, 2)]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_extendedprice double, l_quantity double, l_linenumber int")
    orders = spark.sql("select id o_orderkey, id o_custkey, timestamp'2026-01-02' o_orderdate from range(1, 3)")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    built = ubl.build(orders, lines).mapInArrow(counted, "path string, content string")
    broken = spark.createDataFrame([("x.xml", "<a"), ("y.xml", None)], "path string, content string")
    got = ubl.item_texts(ubl.parse(built.union(broken)), "invoice")
    assert got.columns == ["key", "invoice", "codes", "descriptions"]
    assert {(r["invoice"], r["codes"]) for r in got.collect()} == {("1", "P2"), ("2", "P9 | P10")}
    assert seen.value == 2
