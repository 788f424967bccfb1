"""Queries of registry rules and registrations over the supplied tables; importing this adds them to ``queries``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import predictions, registry
from .adaptor import table
from .queries import query

_K = "o_orderkey"


@query(
    r"""WITH l AS (SELECT o_orderkey AS k, sha256(o_orderkey::VARCHAR) AS h FROM orders),
v AS (SELECT k, CASE WHEN k % 11 = 0 THEN h ELSE h || h[1:32] END AS cufe, CASE WHEN k % 13 <> 0 THEN 'CUFE' END AS kt, repeat('d', k % 83) AS doc, repeat('f', k % 53) AS folio, repeat('p', k % 31) AS pre, repeat('v', k % 12) AS div,
  repeat('x', k % 22) AS fp, repeat('m', k % 23) AS mp, k % 17 = 0 AS no_em, k % 19 = 0 AS no_re, repeat('1', k % 21) AS ne, repeat('n', k % 307) AS nome, repeat('2', k % 24) AS nr, repeat('r', k % 302) AS nomr,
  k % 29 = 0 AS no_total, repeat('e', k % 103) AS est, repeat('g', k % 54) AS gru, CASE WHEN k % 37 = 0 THEN 'x' ELSE h END AS rh, CASE WHEN k % 41 = 0 THEN '' ELSE h END AS ch,
  CASE k % 43 WHEN 0 THEN 'x' WHEN 1 THEN '1' WHEN 2 THEN '[1]' ELSE '{"a":1}' END AS js FROM l)
SELECT k AS id, concat_ws('; ', CASE WHEN length(cufe) <> 96 THEN 'CUFE/CUDE inválido' END, CASE WHEN kt IS NULL THEN 'Tipo de clave inválido' END,
 CASE WHEN length(doc) NOT BETWEEN 1 AND 80 THEN 'Tipo de documento inválido' END, CASE WHEN length(folio) NOT BETWEEN 1 AND 50 THEN 'Folio inválido' END,
 CASE WHEN length(pre) > 30 THEN 'Prefijo demasiado largo' END, CASE WHEN length(div) > 10 THEN 'Divisa demasiado larga' END, CASE WHEN length(fp) > 20 THEN 'Forma de pago demasiado larga' END,
 CASE WHEN length(mp) > 20 THEN 'Medio de pago demasiado largo' END, CASE WHEN no_em THEN 'Fecha de emisión obligatoria' END, CASE WHEN no_re THEN 'Fecha de recepción obligatoria' END,
 CASE WHEN length(ne) NOT BETWEEN 1 AND 20 THEN 'NIT del emisor inválido' END, CASE WHEN length(nome) NOT BETWEEN 1 AND 300 THEN 'Nombre del emisor inválido' END,
 CASE WHEN length(nr) NOT BETWEEN 1 AND 20 THEN 'NIT del receptor inválido' END, CASE WHEN length(nomr) NOT BETWEEN 1 AND 300 THEN 'Nombre del receptor inválido' END,
 CASE WHEN no_total THEN 'Total obligatorio' END, CASE WHEN length(est) NOT BETWEEN 1 AND 100 THEN 'Estado DIAN inválido' END, CASE WHEN length(gru) NOT BETWEEN 1 AND 50 THEN 'Grupo de origen inválido' END,
 CASE WHEN length(rh) <> 64 THEN 'Hash de fila inválido' END, CASE WHEN length(ch) <> 64 THEN 'Hash de contenido inválido' END, CASE WHEN js IN ('x', '1') THEN 'JSON de origen inválido' END) AS errors FROM v"""
)
def listing_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All broken rules of a listing row for each order; order keys give lengths and gaps."""
    k, h = F.col(_K), F.sha2(F.col(_K).cast("string"), 256)
    long = lambda letter, n: F.repeat(F.lit(letter), (k % n).cast("int"))
    every = lambda n, value: F.when(k % n != 0, value)
    columns = {
        "cufe_cude": F.when(k % 11 == 0, h).otherwise(F.concat(F.upper(h), F.substring(h, 1, 32))), "key_type": every(13, F.lit("cufe")), "tipo_de_documento": long("d", 83), "folio": long("f", 53), "prefijo": long("p", 31),
        "divisa": long("v", 12), "forma_de_pago": long("x", 22), "medio_de_pago": long("m", 23), "fecha_emision": every(17, F.col("o_orderdate")), "fecha_recepcion": every(19, F.col("o_orderdate")), "nit_emisor": long("1", 21),
        "nombre_emisor": long("n", 307), "nit_receptor": long("2", 24), "nombre_receptor": long("r", 302), "total": every(29, F.col("o_totalprice")), "estado": long("e", 103), "grupo": long("g", 54),
        "row_hash": F.when(k % 37 == 0, "x").otherwise(h), "content_hash": F.when(k % 41 == 0, "").otherwise(h),
        "original_json": F.when(k % 43 == 0, "x").when(k % 43 == 1, "1").when(k % 43 == 2, "[1]").otherwise('{"a":1}'),
    }
    return table(spark, sf_dir, "orders").withColumns(columns).select(k.alias("id"), rules.listing_errors().alias("errors"))


@query(
    r"""WITH v AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS p, l_shipdate::DATE::VARCHAR AS day, l_extendedprice AS price FROM lineitem)
SELECT id, CASE WHEN p % 47 = 0 THEN 'FilaJson no es JSON valido.' WHEN p % 43 = 0 OR p % 41 = 0 THEN 'FilaJson contiene estructuras o columnas demasiado largas.' WHEN p % 37 = 0 THEN 'IndContabilidad obligatorio o demasiado largo.'
 WHEN p % 31 = 0 THEN 'Fecha invalida; use aaaa-mm-dd.' WHEN p % 102 NOT BETWEEN 1 AND 100 THEN 'Documento obligatorio o demasiado largo.' WHEN p % 52 NOT BETWEEN 1 AND 50 THEN 'TipoDoc obligatorio o demasiado largo.'
 WHEN p % 29 = 0 THEN 'NumDoc obligatorio o demasiado largo.' WHEN p % 53 NOT BETWEEN 1 AND 50 THEN 'Cuenta obligatoria o demasiado larga.' WHEN p % 23 = 0 THEN 'Naturaleza debe ser D o C.' WHEN p % 19 = 0 THEN 'Debito y Credito deben ser decimales.'
 WHEN p % 17 = 0 THEN 'Debito o Credito tienen mas de 4 decimales significativos.' WHEN p % 103 NOT BETWEEN 1 AND 100 THEN 'IdentidadTercero obligatorio o demasiado largo.' WHEN p % 13 = 0 THEN 'FechaSistema invalida.'
 WHEN p % 304 > 300 THEN 'Nombre demasiado largo.' WHEN p % 11 = 0 THEN 'Concepto demasiado largo.' WHEN p % 105 > 100 THEN 'Codigo o identificador demasiado largo.' WHEN p % 22 > 20 THEN 'Dv demasiado largo.' END AS error FROM v"""
)
def movement_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first broken rule of a JSON movement for each line; part keys give lengths and gaps."""
    p = F.col("l_partkey")
    long = lambda letter, n: F.repeat(F.lit(letter), (p % n).cast("int"))
    every = lambda n, value: F.when(p % n != 0, value)
    day = F.to_date("l_shipdate").cast("string")
    members = {
        "IndContabilidad": every(37, F.lit("i")), "Fecha": F.when(p % 31 == 0, "2026-02-30").otherwise(F.when(p % 2 == 0, F.replace(day, F.lit("-"), F.lit("/"))).otherwise(day)), "Documento": long("d", 102), "TipoDoc": long("t", 52),
        "NumDoc": F.when(p % 29 == 0, "  ").otherwise("n"), "Cuenta": long("5", 53), "Naturaleza": F.when(p % 23 == 0, "X").when(p % 2 == 0, "d").otherwise(" C "), "Debito": F.when(p % 19 == 0, "1e3").when(p % 17 == 0, "1.00001").otherwise("12.5000"),
        "Credito": F.lit("0"), "IdentidadTercero": long("9", 103), "FechaSistema": F.when(p % 13 == 0, "ayer").when(p % 2 == 0, "2026-01-02T03:04:05.678"), "NomCuenta": long("c", 304), "Concepto": F.when(p % 11 == 0, F.repeat(F.lit("x"), 2001)),
        "Centro": long("z", 105), "Dv": long("v", 22), "NomCiudad": F.when(p % 41 == 0, F.repeat(F.lit("x"), 4001)),
    }
    flat = F.to_json(F.struct(*[v.alias(m) for m, v in members.items()]), {"ignoreNullFields": "false"})
    payload = F.when(p % 47 == 0, "{").when(p % 43 == 0, F.replace(flat, F.lit('"Credito":"0"'), F.lit('"Credito":["0"]'))).otherwise(flat)
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), payload.alias("payload"))
    return rules.movements_of_json(rows, "payload").select("id", "error")


@query(
    """WITH b AS (SELECT o_orderkey AS k, 1 + o_orderkey % 2 AS ds, date_diff('day', DATE '1990-01-01', o_orderdate::DATE) AS age FROM orders)
SELECT k AS xml_id, CASE WHEN reason IS NOT NULL THEN 'RECHAZADA' WHEN k % 5 <> 0 THEN 'REGISTRADA' WHEN k % 15 = 0 OR k % 35 = 0 OR k % 55 = 0 THEN 'CONFLICTO' ELSE 'YA_EXISTE' END AS outcome, reason FROM (SELECT *,
 CASE WHEN k % 13 = 0 THEN 'ids' WHEN k % 17 = 0 THEN 'model name' WHEN k % 19 = 0 THEN 'hashes' WHEN k % 23 = 0 THEN 'labels' WHEN k % 29 = 0 THEN 'probabilities' WHEN k % 31 = 0 THEN 'dataset of another client'
 WHEN k % 5 = 0 THEN NULL WHEN k % 37 = 0 THEN 'no current invoice' WHEN k % 41 = 0 THEN 'trained' WHEN age <= CASE ds WHEN 1 THEN 1000 ELSE 2000 END THEN 'historical' END AS reason FROM b)"""
)
def prediction_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome and reason of a prediction for each order, two datasets, and every fifth prediction stored before."""
    k, digest = F.col("xml_id"), F.repeat(F.lit("aB"), 32)
    orders = table(spark, sf_dir, "orders").select(F.col(_K).alias("xml_id"), F.to_date("o_orderdate").alias("day"))
    entry = lambda label, p: F.struct(label.alias("label"), p.cast("decimal(18,12)").alias("probability"))
    top = F.array(entry(F.lit("A"), F.when(k % 29 == 0, F.lit(0.1)).otherwise(F.lit(0.5))), entry(F.when(k % 23 == 0, "A").otherwise("B"), F.lit(0.3)), entry(F.lit("C"), F.lit(0.2)))
    batch = orders.select(
        "xml_id", F.when(k % 31 == 0, 9).otherwise(1).alias("client_id"), F.when(k % 13 == 0, 2).otherwise(1).alias("extractor_version"), (1 + k % 2).cast("int").alias("dataset_version"),
        F.when(k % 17 == 0, F.repeat(F.lit("m"), 121)).otherwise(" m ").alias("model_name"), F.when(k % 19 == 0, "x").otherwise(digest).alias("model_hash"), digest.alias("manifest_hash"), digest.alias("feature_hash"), top.alias("top"),
    )
    third = F.lit(0.2) + F.when(k % 3 == 0, 1e-5).otherwise(1e-7)
    changed = F.array(F.col("top")[0], F.when(k % 7 == 0, entry(F.lit("other"), F.lit(0.3))).otherwise(F.col("top")[1]), entry(F.lit("C"), third))
    stored = batch.where(k % 5 == 0).withColumns({"top": changed, "feature_hash": F.when(k % 11 == 0, F.repeat(F.lit("cd"), 32)).otherwise(digest)})
    start = F.to_date(F.lit("1990-01-01"))
    datasets = spark.range(1, 3).select(F.col("id").cast("int").alias("dataset_version"), F.lit(1).alias("client_id"), F.date_add(start, (F.col("id") * 1000).cast("int")).alias("created_at"))
    invoices = orders.where(k % 37 != 0).select(F.lit(1).alias("client_id"), "xml_id", F.col("day").alias("extracted_at"))
    trained = orders.where(k % 41 == 0).select((1 + k % 2).cast("int").alias("dataset_version"), "xml_id")
    return predictions.register(batch, stored, datasets, invoices, trained).select("xml_id", "outcome", "reason")


@query(
    """WITH p AS (SELECT o_custkey % 50 AS item, o_orderkey % 40 AS etag, o_orderkey % 700 AS hash, CASE WHEN o_orderkey % 4 = 0 THEN 'ERROR' ELSE 'OK' END AS state, o_orderkey AS load_id FROM orders WHERE o_orderkey % 8 < 4),
s AS (SELECT item, etag, min(load_id) AS same_load FROM p GROUP BY ALL),
f AS (SELECT hash, coalesce(min(load_id) FILTER (state = 'OK'), min(load_id)) AS load_id, count(*) FILTER (state = 'OK') > 0 AS ok FROM p GROUP BY hash)
SELECT o_orderkey AS request, CASE WHEN same_load IS NOT NULL THEN 'SOLICITUD_EXISTENTE' WHEN f.load_id IS NULL THEN 'NUEVA_CARGA' WHEN NOT ok THEN 'REINTENTO' ELSE 'SIN_CAMBIOS' END AS outcome, coalesce(same_load, f.load_id) AS load_id
FROM (SELECT o_orderkey, o_custkey % 50 AS item, o_orderkey % 40 AS etag, o_orderkey % 900 AS hash FROM orders WHERE o_orderkey % 8 >= 4) r LEFT JOIN s USING (item, etag) LEFT JOIN f USING (hash)"""
)
def listing_load_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders are earlier loads, the others ask for one."""
    k = F.col(_K)
    loads = lambda hashes: table(spark, sf_dir, "orders").select(F.lit(1).alias("client"), (F.col("o_custkey") % 50).alias("item"), (k % 40).alias("etag"), (k % hashes).alias("hash"), F.when(k % 4 == 0, "ERROR").otherwise("OK").alias("state"), k.alias("load_id"))
    asked = loads(900).where("load_id % 8 >= 4").select("client", "item", "etag", "hash", F.col("load_id").alias("request"))
    # The outcome depends on the four columns alone, so equal requests are asked once.
    out = registry.start_loads(asked.select("client", "item", "etag", "hash").distinct(), loads(700).where("load_id % 8 < 4"))
    return asked.join(out, ["client", "item", "etag", "hash"]).select("request", "outcome", "load_id")


@query(
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'NUEVO' WHEN c_custkey % 5 = 0 THEN 'REQUIERE_REVISION' ELSE 'EXISTENTE' END AS outcome FROM customer"""
)
def client_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    nit = F.concat(F.lit("n"), k.cast("string"))
    stored = c.where(k % 3 != 0).select(F.upper(nit).alias("nit"), F.when(k % 5 == 0, "other").otherwise(F.upper("c_name")).alias("name"))
    return registry.register_clients(c.select(k.alias("id"), F.concat(F.lit(" "), nit).alias("nit"), F.col("c_name").alias("name")), stored).select("id", "outcome")


@query(
    """SELECT o_orderkey AS document_id, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'RECHAZADO' WHEN o_orderkey % 2 = 0 THEN 'XML_EXISTENTE' ELSE 'XML_REGISTRADO' END AS outcome FROM orders"""
)
def xml_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, h = F.col(_K), F.sha2(F.col(_K).cast("string"), 256)
    digest = F.when(k % 7 == 0, F.upper(h)).otherwise(h)
    path = F.concat(F.lit("client/"), k.cast("string"), F.lit("/"), F.when(k % 11 == 0, "other").otherwise(digest), F.lit(".xml"))
    orders = table(spark, sf_dir, "orders")
    return registry.register_xml(orders.select(k.alias("document_id"), path.alias("path"), digest.alias("sha256")), orders.where(k % 2 == 0).select(k.alias("document_id"))).select("document_id", "outcome")


@query(
    """WITH b AS (SELECT o_orderkey AS k, o_orderkey % 4 = 0 AS error, o_orderkey % 3 = 0 AS done, o_orderkey % 5 = 0 AS bad FROM orders)
SELECT k AS xml_id, CASE WHEN NOT error THEN CASE WHEN done THEN 'EXISTENTE' WHEN bad THEN 'ERROR_REGISTRADO' ELSE 'REGISTRADA' END WHEN done THEN 'YA_EXTRAIDO' ELSE 'ERROR_REGISTRADO' END AS outcome FROM b"""
)
def extraction_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col(_K)
    ids = lambda n: table(spark, sf_dir, "orders").where(k % n == 0).select(k.alias("xml_id"))
    parsed = table(spark, sf_dir, "orders").select(k.alias("xml_id"), F.when(k % 4 == 0, "not well formed").alias("error"))
    return registry.register_extractions(parsed, ids(3), ids(5)).select("xml_id", "outcome")


@query(
    """SELECT o_orderkey AS xml_id FROM orders WHERE o_orderdate > DATE '1995-06-01' AND o_orderkey % 3 <> 0 AND o_orderkey % 10 <> 0"""
)
def pending_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after a day that were not trained on, nor predicted by this model; predictions of another model don't count."""
    k = F.col(_K)
    orders = table(spark, sf_dir, "orders")
    predicted = orders.where(k % 5 == 0).select(k.alias("xml_id"), F.when(k % 10 == 0, "m").otherwise("other").alias("model_hash"))
    extracted = orders.select(k.alias("xml_id"), F.col("o_orderdate").alias("extracted_at"))
    return predictions.pending(extracted, orders.where(k % 3 == 0).select(k.alias("xml_id")), predicted, "m", F.to_date(F.lit("1995-06-01"))).select("xml_id")
