"""Views over documents and their current XML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_invoices(documents: DataFrame, versions: DataFrame, extractions: DataFrame, extractor: int = 1) -> DataFrame:
    """One row per current, processed invoice that is not held for review, with computed columns.

    documents: document_id, client_id, key, state, review; versions: document_id, version_id,
    load_id, is_current; extractions: document_id, xml_id, extractor_version, root and amounts.
    """
    d = documents.where((F.col("state") == "PROCESADO") & (F.coalesce(F.col("review"), F.lit("")) != "PENDIENTE"))
    v = versions.where("is_current").select("document_id", "version_id", "load_id")
    x = extractions.where((F.col("extractor_version") == extractor) & (F.col("root") == "Invoice"))
    iva, inc = F.coalesce("iva_total", F.lit(0)) > 0, F.coalesce("inc_total", F.lit(0)) > 0
    return (
        d.join(v, "document_id")
        .join(x, "document_id")
        .withColumns(
            {
                "load_tag": F.concat(F.lit("dian:"), F.col("load_id").cast("string")),
                "has_iva": iva.cast("int"),
                "has_inc": inc.cast("int"),
                "suggested_rows": 2 + iva.cast("int") + inc.cast("int"),
                "item_supplier": F.concat(F.col("item_1"), F.lit(" - "), F.col("supplier_name")),
                "industry_note": F.lit(None).cast("string"),
            }
        )
    )


def with_technical_ids(view: DataFrame, loads: DataFrame) -> DataFrame:
    """The view joined back to its loads by the computed tag, with the load's own type test in the join."""
    tagged = loads.select(F.concat(F.lit("dian:"), F.col("load_id").cast("string")).alias("load_tag"), F.col("client_id").alias("load_client"), F.col("kind"))
    return view.join(tagged, (view["load_tag"] == tagged["load_tag"]) & (tagged["kind"] == "listing") & (view["client_id"] == tagged["load_client"])).drop(tagged["load_tag"]).drop("load_client", "kind")


def pending_extraction(xml: DataFrame, extracted: DataFrame, failed: DataFrame, limit: int | None = 100) -> DataFrame:
    """XML documents neither extracted nor failed, oldest first; at most 100 a sweep by default."""
    out = xml.join(extracted.select("xml_id"), "xml_id", "left_anti").join(failed.select("xml_id"), "xml_id", "left_anti")
    return out.orderBy("created", "xml_id").limit(limit) if limit else out


def extraction_flags(xml: DataFrame, extracted: DataFrame, failed: DataFrame, extractor: int = 1) -> DataFrame:
    """Each XML document with whether this extractor has finished it or failed on it."""
    done = extracted.where(F.col("extractor_version") == extractor).select("xml_id").distinct().withColumn("is_extracted", F.lit(True))
    bad = failed.where(F.col("extractor_version") == extractor).select("xml_id").distinct().withColumn("is_failed", F.lit(True))
    return xml.join(done, "xml_id", "left").join(bad, "xml_id", "left").na.fill(False, ["is_extracted", "is_failed"])


def of_client(invoices: DataFrame, documents: DataFrame, client: int) -> DataFrame:
    """Invoices (key, load_tag) of a client's documents (client_id, key, first_load_id), by key and first load."""
    own = documents.where(F.col("client_id") == client).select("key", F.concat(F.lit("dian:"), F.col("first_load_id").cast("string")).alias("load_tag"))
    return invoices.join(own, ["key", "load_tag"], "left_semi")


def in_load(invoices: DataFrame, documents: DataFrame, load_rows: DataFrame, client: int, load_id: int) -> DataFrame:
    """A client's invoices that also have a valid row (document_id, load_id, outcome) in one load: two semi joins, whatever the number of rows of either."""
    valid = load_rows.where((F.col("load_id") == load_id) & (F.col("outcome") != "RECHAZADO"))
    listed = documents.where(F.col("client_id") == client).join(valid, "document_id", "left_semi").select("key")
    return of_client(invoices, documents, client).join(listed, "key", "left_semi")


def semantic_differences(headers: DataFrame) -> DataFrame:
    """``headers`` with what the two meanings of discount and charge differ in."""
    return headers.withColumns({"discount_differs": F.col("allowanceTotal") != F.col("legacyDiscount"), "charge_differs": F.col("chargeTotal") != F.col("legacyCharge")})


#: Names of the compatibility view's columns, and the members of a header that they show.
_HEADER = {
    "id_factura": "invoiceId", "cufe": "uuid", "factura_completa": "invoiceId", "fecha_emision": "issueDate", "nit_proveedor": "supplierNit", "nombre_proveedor": "supplierName", "ciudad_proveedor": "supplierCity",
    "tax_level_proveedor": "supplierTaxLevel", "tax_scheme_id": "supplierTaxSchemeId", "tax_scheme_nombre": "supplierTaxSchemeName", "codigo_industria_proveedor": "supplierIndustryCode", "cantidad_lineas_xml": "lineCount",
    "line_extension_amount": "lineExtensionAmount", "tax_exclusive_amount": "taxExclusiveAmount", "tax_inclusive_amount": "taxInclusiveAmount", "payable_amount": "payableAmount", "iva_total": "ivaTotal", "inc_total": "incTotal",
    "descuento_total": "legacyDiscount", "recargo_total": "legacyCharge", "cantidad_items_total": "lineCount", "descripcion_item_1": "firstDescription", "valor_base_sugerido": "taxExclusiveAmount",
    "valor_iva_sugerido": "ivaTotal", "valor_inc_sugerido": "incTotal", "valor_cxp_sugerido": "payableAmount",
}
_FLAGS = {"tiene_iva": "ivaTotal", "tiene_inc": "incTotal", "flag_descuento": "legacyDiscount", "flag_recargo": "legacyCharge"}


def compatibility_view(headers: DataFrame, documents: DataFrame, extractor: int = 1) -> DataFrame:
    """The 34 columns of the historical sheet: a row per current, processed invoice that isn't held for review.

    headers: the committed ones of ``extraction``; documents: xml_id, is_current, state, review, first_load_id.
    """
    own = documents.where(F.col("is_current") & (F.col("state") == "PROCESADO") & (F.coalesce("review", F.lit("")) != "PENDIENTE")).select("xml_id", "first_load_id")
    return historical(headers.join(own, "xml_id"), extractor)


def historical(rows: DataFrame, extractor: int = 1) -> DataFrame:
    """The same columns of headers that have their document's first_load_id already, as where both come from one batch."""
    rows = rows.where((F.col("extractorVersion") == extractor) & (F.col("xmlType") == "Invoice"))
    flag = lambda c: F.coalesce((F.col(c) > 0).cast("int"), F.lit(0))
    return rows.select(
        F.concat(F.lit("dian:"), F.col("first_load_id").cast("string")).alias("id_carga"),
        *[F.col(c).alias(name) for name, c in _HEADER.items()],
        *[flag(c).alias(name) for name, c in _FLAGS.items()],
        F.concat("firstDescription", F.lit(" - "), "supplierName").alias("item1_proveedor"),
        (2 + flag("ivaTotal") + flag("incTotal")).alias("n_registros_sugeridos"),
        F.lit(None).cast("string").alias("observaciones"),
    )
