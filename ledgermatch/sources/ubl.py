"""UBL documents: reading with verification, strict parsing, and writing of test documents.

Parsing is Arrow-batched Python with the standard library's parser: ``xpath_string`` expands
entities of a DTD and fails the job on malformed input, while the strict rules here give each
bad document its own error.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name spaces of the standard.
UBL = "urn:oasis:names:specification:ubl:schema:xsd:"
CBC, CAC = f"{{{UBL}CommonBasicComponents-2}}", f"{{{UBL}CommonAggregateComponents-2}}"
ROOTS = {f"{{{UBL}{kind}-2}}{kind}": kind for kind in ("Invoice", "CreditNote")}
LINE = {"Invoice": "InvoiceLine", "CreditNote": "CreditNoteLine"}
QUANTITY = {"Invoice": "InvoicedQuantity", "CreditNote": "CreditedQuantity"}
IVA, INC = "01", "04"
#: Bounds of an amount.
LARGEST, DECIMALS = Decimal(10) ** 20, 18

HEADER = (
    "struct<root:string,key:string,invoice:string,issue_date:string,supplier_nit:string,supplier_name:string,customer_nit:string,customer_name:string,"
    "currency:string,line_count:int,line_extension:string,tax_exclusive:string,tax_inclusive:string,payable:string,iva_total:string,inc_total:string,"
    "discount:string,charge:string,legacy_discount:string,notes:string>"
)
LINES = "array<struct<ordinal:int,line_id:string,item_code:string,supplier_code:string,description:string,quantity:string,amount:string,currency:string>>"
PARSED = f"path string, header {HEADER}, lines {LINES}, error string"


def read_verified(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """(path, content) of the files whose length and SHA-256 are those of ``expected`` (path, size, sha256)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    joined = files.join(expected.withColumnRenamed("path", "_path"), F.col("path") == F.col("_path"))
    return joined.where((F.col("length") == F.col("size")) & (F.sha2("content", 256) == F.col("sha256"))).select("path", F.col("content").cast("string").alias("content"))


def content_path(client: Column, key: Column, content: Column) -> Column:
    """Where content is stored: by its own hash, so the same content is written once."""
    return F.concat_ws("/", client.cast("string"), key, F.concat(F.sha2(content, 256), F.lit(".xml")))


class Invalid(ValueError):
    """A rule that a document breaks."""


def _text(node, path: str, needed: bool = False) -> str | None:
    found = node.find(path) if node is not None else None
    value = (found.text or "").strip() if found is not None else ""
    if needed and not value:
        raise Invalid(f"missing {path.replace(CBC, '').replace(CAC, '')}")
    return value or None


def _amount(value: str | None) -> Decimal | None:
    if value is None:
        return None
    try:
        number = Decimal(value)
    except InvalidOperation:
        raise Invalid("amount is not a number") from None
    if not number.is_finite() or abs(number) >= LARGEST:
        raise Invalid("amount out of range")
    if -number.as_tuple().exponent > DECIMALS:
        raise Invalid("amount has too many decimals")
    return number


def _plain(number: Decimal | None) -> str | None:
    return None if number is None else format(number, "f")


def _party(root, role: str) -> tuple[str, str]:
    """Tax id and name, which both parties must have."""
    party = root.find(f"{CAC}Accounting{role}Party/{CAC}Party")
    scheme = f"{CAC}PartyTaxScheme/"
    nit = _text(party, f"{scheme}{CBC}CompanyID")
    if not nit:
        raise Invalid(f"no tax id of {role.lower()}")
    name = _text(party, f"{scheme}{CBC}RegistrationName") or _text(party, f"{CAC}PartyName/{CBC}Name")
    if not name:
        raise Invalid(f"no name of {role.lower()}")
    return nit, name


def parse_document(content: str) -> tuple[dict, list[dict]]:
    """Header and lines of one document; raises Invalid with the first rule that it breaks."""
    if "<!" in content and re.search(r"<!\s*DOCTYPE|<!\s*ENTITY", content, re.I):
        raise Invalid("DTD is not allowed")
    try:
        root = ElementTree.fromstring(content)
    except ElementTree.ParseError:
        raise Invalid("not well formed") from None
    kind = ROOTS.get(root.tag)
    if not kind:
        raise Invalid("other root")
    key = _text(root, f"{CBC}UUID", needed=True).lower()
    if not re.fullmatch("[0-9a-f]{96}", key):
        raise Invalid("key is not 96 hex digits")
    date = _text(root, f"{CBC}IssueDate", needed=True)
    try:
        valid = re.fullmatch(r"\d{4}-\d\d-\d\d", date) and datetime.date.fromisoformat(date)
    except ValueError:
        valid = None
    if not valid:
        raise Invalid("issue date is not ISO")
    supplier, customer = _party(root, "Supplier"), _party(root, "Customer")
    nodes = root.findall(f"{CAC}{LINE[kind]}")
    declared = _amount(_text(root, f"{CBC}LineCountNumeric"))
    if not nodes:
        raise Invalid("no lines")
    if declared is None or declared != len(nodes):
        raise Invalid("other number of lines")
    totals = root.find(f"{CAC}LegalMonetaryTotal")
    payable = totals.find(f"{CBC}PayableAmount") if totals is not None else None
    currency = payable.get("currencyID") if payable is not None else None
    # Totals, tax subtotals and lines have one currency; amounts elsewhere, as in extensions, may have others.
    parts = [*(totals if totals is not None else ()), *(x for t in root.findall(f"{CAC}TaxTotal") for s in t.findall(f"{CAC}TaxSubtotal") for x in s), *(x for n in nodes for x in n)]
    if any(x.tag.endswith("Amount") and x.get("currencyID") not in (None, currency) for x in parts):
        raise Invalid("two currencies")
    amounts = {name: _plain(_amount(_text(totals, f"{CBC}{tag}"))) for name, tag in (("line_extension", "LineExtensionAmount"), ("tax_exclusive", "TaxExclusiveAmount"), ("tax_inclusive", "TaxInclusiveAmount"), ("payable", "PayableAmount"), ("discount", "AllowanceTotalAmount"), ("charge", "ChargeTotalAmount"))}
    if amounts["payable"] is None:
        raise Invalid("no payable amount")
    taxes = {IVA: None, INC: None}
    for total in root.findall(f"{CAC}TaxTotal"):
        for part in total.findall(f"{CAC}TaxSubtotal"):
            scheme = _text(part, f"{CAC}TaxCategory/{CAC}TaxScheme/{CBC}ID")
            if scheme in taxes:
                taxes[scheme] = (taxes[scheme] or Decimal(0)) + (_amount(_text(part, f"{CBC}TaxAmount")) or Decimal(0))
    # Names of tags stand in the content as they are: most documents need no walk.
    legacy = "MntDctoCop" in content and next((n.text for n in root.iter() if n.tag.rpartition("}")[2] == "MntDctoCop" and (n.text or "").strip()), None)
    lines = []
    for i, node in enumerate(nodes, 1):
        item = node.find(f"{CAC}Item")
        amount = node.find(f"{CBC}LineExtensionAmount")
        lines.append(
            {
                "ordinal": i,
                "line_id": _text(node, f"{CBC}ID"),
                "item_code": _text(item, f"{CAC}StandardItemIdentification/{CBC}ID"),
                "supplier_code": _text(item, f"{CAC}SellersItemIdentification/{CBC}ID"),
                "description": _text(item, f"{CBC}Description"),
                "quantity": _plain(_amount(_text(node, f"{CBC}{QUANTITY[kind]}"))),
                "amount": _plain(_amount(_text(node, f"{CBC}LineExtensionAmount"))),
                "currency": amount.get("currencyID") if amount is not None else None,
            }
        )
    notes = " ".join(x.text.strip() for x in root.findall(f"{CBC}Note") if x.text and x.text.strip())
    header = {
        "root": kind, "key": key, "invoice": _text(root, f"{CBC}ID", needed=True), "issue_date": date, "supplier_nit": supplier[0], "supplier_name": supplier[1],
        "customer_nit": customer[0], "customer_name": customer[1], "currency": currency, "line_count": len(lines), **amounts,
        "iva_total": _plain(taxes[IVA]), "inc_total": _plain(taxes[INC]), "legacy_discount": _plain(_amount(legacy.strip())) if legacy else None, "notes": notes or None,
    }
    return header, lines


def parse(documents: DataFrame) -> DataFrame:
    """(path, header, lines, error) of documents (path, content); a document has an error or a header.  A null content is not well formed."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, headers, lines, errors = batch.column("path"), [], [], []
            for content in batch.column("content").to_pylist():
                try:
                    header, own, error = *parse_document(content or ""), None
                except Invalid as e:
                    header, own, error = None, None, str(e)
                headers.append(header)
                lines.append(own)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([paths.cast(pa.string()), pa.array(headers, _arrow(HEADER)), pa.array(lines, pa.list_(_arrow(LINES))), pa.array(errors, pa.string())], ["path", "header", "lines", "error"])

    return documents.select("path", "content").mapInArrow(of, PARSED)


def _arrow(schema: str) -> pa.DataType:
    """The Arrow type of a flat struct of texts and ints, or of an array's struct."""
    return pa.struct([(n, pa.int32() if kind == "int" else pa.string()) for n, kind in re.findall(r"(\w+):(\w+)", schema)])


def _escape(x: Column) -> Column:
    out = F.coalesce(x, F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(mark), F.lit(name))
    return out


def build(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """(path, content): an invoice document for each order with lines."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    money = lambda c: F.format_string("%.2f", c / 100)
    tag = lambda name, value, extra="": F.concat(F.lit(f"<cbc:{name}{extra}>"), _escape(value), F.lit(f"</cbc:{name}>"))
    lines = lineitem.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", cents.alias("cents")))).alias("ls"), F.sum(cents).alias("total"), F.count(F.lit(1)).alias("n")
    )
    cop = ' currencyID="COP"'
    one = F.transform(
        "ls",
        lambda e, i: F.concat(
            F.lit("<cac:InvoiceLine>"), tag("ID", (i + 1).cast("string")), tag("InvoicedQuantity", e["l_quantity"].cast("string")), tag("LineExtensionAmount", money(e["cents"]), cop),
            F.lit("<cac:Item>"), tag("Description", F.concat(F.lit("Part & <co> "), e["l_partkey"].cast("string"))), F.lit("<cac:StandardItemIdentification>"),
            tag("ID", F.concat(F.lit("P"), e["l_partkey"].cast("string"))), F.lit("</cac:StandardItemIdentification></cac:Item></cac:InvoiceLine>"),
        ),
    )
    key = F.substring(F.concat(F.sha2(F.col("o_orderkey").cast("string"), 256), F.sha2(F.col("o_orderkey").cast("string"), 224)), 1, 96)
    content = F.concat(
        F.lit(f'<Invoice xmlns="{UBL}Invoice-2" xmlns:cac="{CAC[1:-1]}" xmlns:cbc="{CBC[1:-1]}">'), tag("ID", F.col("o_orderkey").cast("string")), tag("UUID", key), tag("IssueDate", F.date_format("o_orderdate", "yyyy-MM-dd")),
        tag("LineCountNumeric", F.col("n").cast("string")), F.lit("<cac:AccountingSupplierParty><cac:Party><cac:PartyTaxScheme>"), tag("RegistrationName", F.lit("Supplier")), tag("CompanyID", F.col("o_custkey").cast("string")),
        F.lit("</cac:PartyTaxScheme></cac:Party></cac:AccountingSupplierParty><cac:AccountingCustomerParty><cac:Party><cac:PartyTaxScheme>"), tag("RegistrationName", F.lit("Customer")), tag("CompanyID", F.lit("900")),
        F.lit("</cac:PartyTaxScheme></cac:Party></cac:AccountingCustomerParty><cac:LegalMonetaryTotal>"), tag("LineExtensionAmount", money(F.col("total")), cop), tag("PayableAmount", money(F.col("total")), cop),
        F.lit("</cac:LegalMonetaryTotal>"), F.array_join(one, ""), F.lit("</Invoice>"),
    )
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".xml")).alias("path"), content.alias("content"))


def item_texts(parsed: DataFrame, *columns: str) -> DataFrame:
    """(key, ``columns`` of the header, codes, descriptions) of each document: distinct item codes in natural order, and their descriptions; one row per key, first path first."""
    from pyspark.sql import Window

    from ..functions import text

    code = lambda e: F.coalesce(e["item_code"], e["supplier_code"])
    items = F.array_sort(F.transform("lines", lambda e: F.struct(text.natural_key(code(e)).alias("k"), F.coalesce(e["description"], F.lit("")).alias("d"), code(e).alias("c"))))
    names = lambda field: F.array_join(F.array_distinct(F.filter(F.transform("_items", lambda e: e[field]), lambda x: x != "")), " | ")
    # The texts are made before the shuffle, which moves no lines then.
    own = parsed.where("error is null").withColumn("_items", items).select("path", "header.key", *[f"header.{c}" for c in columns], names("c").alias("codes"), names("d").alias("descriptions"))
    return own.withColumn("_r", F.row_number().over(Window.partitionBy("key").orderBy("path"))).where("_r = 1").select("key", *columns, "codes", "descriptions")
