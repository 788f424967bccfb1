import hashlib
import json
from datetime import datetime

from pyspark.sql import functions as F

from ledgermatch.functions import rules
from ledgermatch.operators import claims, dataset, predictions, registry, split


def test_documents(spark):
    rows = [(1, "k", "h1", True), (2, "k", "h1", True), (3, "k", "h2", True), (4, "k", "h1", True), (5, "k", "h9", False), (6, "k", "h3", True), (7, "j", "h1", True)]
    df = spark.createDataFrame(rows, "n int, key string, hash string, ok boolean")
    out = {r["n"]: (r["outcome"], r["revision"]) for r in registry.resolve_documents(df, ["key"], "hash", ["n"], F.col("ok")).collect()}
    assert out == {1: ("NUEVO", 1), 2: ("DUPLICADO", 1), 3: ("NUEVA_REVISION", 2), 4: ("DUPLICADO", 1), 5: ("RECHAZADO", None), 6: ("NUEVA_REVISION", 3), 7: ("NUEVO", 1)}
    current = registry.current_revisions(registry.resolve_documents(df, ["key"], "hash", ["n"], F.col("ok")), ["key"])
    assert {r["key"]: r["n"] for r in current.collect()} == {"k": 6, "j": 7}


def test_movements_and_counters(spark):
    rows = [(1, "a", "x", True), (2, "a", "x", True), (3, "a", "y", True), (4, "b", "x", True), (5, "c", None, False), (6, "a", "x", True)]
    df = spark.createDataFrame(rows, "n int, id string, hash string, ok boolean").withColumn("load", F.lit(1)).withColumn("at", F.col("n"))
    out = registry.resolve_movements(df, ["id"], "hash", ["n"], F.col("ok"))
    assert [r["outcome"] for r in out.orderBy("n").collect()] == ["NUEVO", "DUPLICADO", "ID_CON_CONTENIDO_DISTINTO", "NUEVO", "RECHAZADO", "DUPLICADO"]
    expected = spark.createDataFrame([(1, 8), (2, 3)], "load int, expected int")
    done = {r["load"]: r for r in registry.load_counters(out, "load", "at", expected).collect()}
    assert (done[1]["new"], done[1]["duplicate"], done[1]["conflict"], done[1]["rejected"], done[1]["pending"], done[1]["state"]) == (2, 2, 1, 1, 2, "PARCIAL")
    assert done[2]["state"] == "ERROR" and done[2]["pending"] == 3


def test_start_loads(spark):
    old = spark.createDataFrame([("c", "i1", "e1", "h1", "OK", 1), ("c", "i2", "e2", "h2", "ERROR", 2), ("c", "i3", "e3", "h3", "ERROR", 3), ("c", "i4", "e4", "h3", "OK", 4)], "client string, item string, etag string, hash string, state string, load_id int")
    new = spark.createDataFrame([("c", "i1", "e1", "h1"), ("c", "x", "x", "h1"), ("c", "x", "y", "h2"), ("c", "x", "z", "h3"), ("c", "x", "w", "h9")], "client string, item string, etag string, hash string")
    out = {r["etag"]: (r["outcome"], r["load_id"]) for r in registry.start_loads(new, old).collect()}
    assert out == {"e1": ("SOLICITUD_EXISTENTE", 1), "x": ("SIN_CAMBIOS", 1), "y": ("REINTENTO", 2), "z": ("SIN_CAMBIOS", 4), "w": ("NUEVA_CARGA", None)}


def test_ids_clients_and_appends(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    ids = registry.assign_ids(df, ["k"], start=10).collect()
    assert sorted((r["k"], r["id"]) for r in ids) == [(i, i + 11) for i in range(1000)]
    stored = spark.createDataFrame([(1, "old")], "k long, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k long, v string")
    assert [(r["k"], r["v"]) for r in registry.append_new(stored, batch, ["k"], ["v"]).collect()] == [(2, "a")]
    known = spark.createDataFrame([("n1", "Name")], "nit string, name string")
    rows = spark.createDataFrame([("N1 ", "name"), ("n1", "Other"), ("n2", "x")], "nit string, name string")
    assert sorted(r["outcome"] for r in registry.register_clients(rows, known).collect()) == ["EXISTENTE", "NUEVO", "REQUIERE_REVISION"]


def test_listing_rules(spark):
    good = {"cufe_cude": "A" * 96, "key_type": " cufe", "tipo_de_documento": "t", "folio": "1", "prefijo": None, "divisa": None, "forma_de_pago": None, "medio_de_pago": None, "fecha_emision": "2026-01-01", "fecha_recepcion": "2026-01-01", "nit_emisor": "9", "nombre_emisor": "n", "nit_receptor": "8", "nombre_receptor": "m", "total": "-1", "estado": "e", "grupo": "g", "row_hash": "b" * 64, "content_hash": "c" * 64, "original_json": "{}"}
    rows = [tuple(good.values()), tuple(None for _ in good), tuple((good | {"prefijo": "p" * 31, "folio": " ", "original_json": "1"}).values())]
    out = [r[0] for r in spark.createDataFrame(rows, ", ".join(f"{c} string" for c in good)).select(rules.listing_errors()).collect()]
    assert out[0] == "" and len(out[1].split("; ")) == 16 and out[2] == "Folio inválido; Prefijo demasiado largo; JSON de origen inválido"


def test_movement_rules_and_hash(spark):
    good = {"IndContabilidad": "i1", "Fecha": "2026/01/02", "Documento": "d/1", "TipoDoc": "FC", "NumDoc": "7", "Cuenta": "5105", "Naturaleza": "d", "Debito": "10", "Credito": "-0.50000", "IdentidadTercero": "9", "Concepto": 'a "b" é'}
    cases = [(good, None), ({k: v for k, v in good.items() if k != "IndContabilidad"}, "IndContabilidad obligatorio o demasiado largo."), (good | {"Credito": "0.00001"}, "Debito o Credito tienen mas de 4 decimales significativos."), (good | {"FechaSistema": "ayer"}, "FechaSistema invalida."), (good | {"Dv": "1" * 21}, "Dv demasiado largo."), (good | {"CC": {"a": 1}}, "FilaJson contiene estructuras o columnas demasiado largas."), ([1], "IndContabilidad obligatorio o demasiado largo.")]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(99, "{"), (100, None)], "n int, payload string")
    out = {r["n"]: r for r in rules.movements_of_json(df, "payload").collect()}
    assert [out[i]["error"] for i in range(len(cases))] == [e for _, e in cases] and out[99]["error"] == out[100]["error"] == "FilaJson no es JSON valido."
    shown = {"Fecha": "2026-01-02", "Documento": "d/1", "TipoDoc": "FC", "NumDoc": "7", "Cuenta": "5105", "Concepto": 'a "b" é', "Naturaleza": "D", "Centro": None, "CC": None, "Debito": "10.0000", "Credito": "-0.5000", "IdentidadTercero": "9", "DocFuente": None}
    canonical = json.dumps(shown, ensure_ascii=False, separators=(",", ":")).replace("/", "\\/")
    assert out[0]["content_hash"] == hashlib.sha256(canonical.encode("utf-16-le")).hexdigest() and out[1]["content_hash"] is None


def test_repeated_requests_get_what_is_stored(spark):
    stored = spark.createDataFrame([(1, 1, "NUEVO"), (1, 9, "NUEVO")], "load_id int, row int, outcome string")
    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "b"), (1, 2, "a"), (2, 1, "c")], "load_id int, row int, v string")
    new, again = registry.first_requests(rows, stored, ["v"])
    assert sorted((r["load_id"], r["row"], r["v"]) for r in new.collect()) == [(1, 2, "a"), (2, 1, "c")]
    assert [tuple(r) for r in again.collect()] == [(1, 1, "NUEVO", True)]


def test_claims(spark):
    t = lambda s: datetime(2026, 1, 1, 0, 0, s)
    rows = [("a", 1, t(1), "REINTENTO"), ("a", 2, t(2), "OK"), ("a", 3, t(3), "REINTENTO"), ("b", 1, t(50), None), ("c", 1, datetime(2025, 12, 31), None), ("d", 5, t(1), "REINTENTO"), ("e", 1, t(1), "NO_ENCONTRADO")]
    df = spark.createDataFrame(rows, "document_id string, attempt int, at timestamp, outcome string")
    out = {r["document_id"]: r["state"] for r in claims.claim_states(df, F.to_timestamp(F.lit("2026-01-01 00:01:00"))).collect()}
    assert out == {"a": "OK", "b": "EN_CURSO", "c": "VENCIDO", "d": "ERROR", "e": "NO_ENCONTRADO"}
    kinds = spark.createDataFrame([(None,), ("not_found",), ("xml",), ("timeout",)], "e string")
    assert [r[0] for r in kinds.select(claims.outcome_of(F.col("e"))).collect()] == ["OK", "NO_ENCONTRADO", "ERROR", "REINTENTO"]


def test_split_and_sampling(spark):
    rows = [(f"2026-{m:02d}-15", c) for m, n in ((1, 60), (2, 25), (3, 15)) for c in ["x"] * (n - 1) + ["rare" if m == 1 else "x"]]
    df = spark.createDataFrame(rows, "day string, c string").withColumn("day", F.to_date("day"))
    assert str(split.split_start(df, "day", 0.2).first()["test_start"]) == "2026-02-01"
    assert str(split.split_start(df, "day", 0.1).first()["test_start"]) == "2026-03-01"
    assert str(split.split_start(df, "day", 0.5).first()["test_start"]) == "2026-02-01"
    assert split.trainable(df, "c").count() == 99
    from datetime import date

    assert split.oversample(df, "day", date(2026, 3, 1), 3).count() == 130
    assert split.majority(df, "c").first()["majority"] == "x"


def test_predictions(spark):
    df = spark.createDataFrame([(["B", "A", "C", "D"], [0.2, 0.6, 0.15, 0.05]), (["B", "A", "C", "D"], [0.25] * 4)], "l array<string>, p array<double>")
    out = df.select(predictions.top(F.col("l"), F.col("p")).alias("t"), predictions.sane(F.col("p")).alias("s")).collect()
    assert [e["label"] for e in out[0]["t"]] == ["A", "B", "C"] and [e["label"] for e in out[1]["t"]] == ["B", "A", "C"] and out[0]["s"]
    h, at = "a" * 64, datetime(2026, 1, 1)
    schema = "xml_id int, client_id int, extractor_version int, dataset_version int, model_name string, model_hash string, manifest_hash string, feature_hash string, top array<struct<label:string,probability:double>>"
    row = lambda i, p=0.5, label="A", version=1, dataset_version=7: (i, 1, version, dataset_version, "m", h, h, h, [(label, p), ("B", 0.3), ("C", 0.1)])
    batch = spark.createDataFrame([row(1), row(2, 0.5 + 6.4e-8), row(3, 0.5 + 2e-6), row(4, label="D"), row(5), row(6), row(7), row(8, label="B"), row(9, 0.2), row(10, version=2), row(11, dataset_version=8)], schema)
    stored = spark.createDataFrame([row(2), row(3), row(4)], schema)
    datasets = spark.createDataFrame([(7, 1, at), (8, 2, at)], "dataset_version int, client_id int, created_at timestamp")
    invoices = spark.createDataFrame([(1, i, datetime(2026, 1, 1 + (i != 6))) for i in range(1, 12) if i != 7], "client_id int, xml_id int, extracted_at timestamp")
    trained = spark.createDataFrame([(7, 5), (8, 1)], "dataset_version int, xml_id int")
    out = {r["xml_id"]: r["reason"] or r["outcome"] for r in predictions.register(batch, stored, datasets, invoices, trained).collect()}
    assert out == {1: "REGISTRADA", 2: "YA_EXISTE", 3: "CONFLICTO", 4: "CONFLICTO", 5: "trained", 6: "historical", 7: "no current invoice", 8: "labels", 9: "probabilities", 10: "ids", 11: "dataset of another client"}


def test_publish_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "xml_id int, label string")
    identity = {c: "x" for c in dataset.IDENTITY if c != "rows_hash"}
    assert dataset.publish(spark, rows, identity, str(tmp_path)) == ("PUBLICADA", 1)
    assert dataset.publish(spark, rows, identity, str(tmp_path)) == ("YA_EXISTE", 1)
    assert dataset.publish(spark, rows.where("xml_id = 1"), identity, str(tmp_path)) == ("PUBLICADA", 2)
    assert dataset.read_version(spark, str(tmp_path), 1).count() == 2


def test_xml_extractions_and_finish(spark):
    h = "a" * 64
    batch = spark.createDataFrame([(1, f"c/1/{h}.xml", h), (2, f"c/2/{h}.xml", h), (3, "c/3/other.xml", h), (2, f"d/2/{h}.xml", h)], "document_id int, path string, sha256 string")
    stored = spark.createDataFrame([(1,)], "document_id int")
    out = {(r["document_id"], r["path"][0]): r["outcome"] for r in registry.register_xml(batch, stored).collect()}
    assert out == {(1, "c"): "XML_EXISTENTE", (2, "c"): "XML_REGISTRADO", (3, "c"): "RECHAZADO", (2, "d"): "XML_EXISTENTE"}
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "xml_id int")
    parsed = spark.createDataFrame([(1, None), (2, None), (3, "e"), (4, "e"), (5, None)], "xml_id int, error string")
    out = {r["xml_id"]: r["outcome"] for r in registry.register_extractions(parsed, ids(2, 4), ids(5)).collect()}
    assert out == {1: "REGISTRADA", 2: "EXISTENTE", 3: "ERROR_REGISTRADO", 4: "YA_EXTRAIDO", 5: "ERROR_REGISTRADO"}
    counters = spark.createDataFrame([(1, "OK"), (2, "PARCIAL")], "load int, state string")
    assert {r["load"]: r["finish"] for r in registry.finish_loads(counters, spark.createDataFrame([(1,)], "load int"), "load").collect()} == {1: "YA_FINALIZADA", 2: "PARCIAL"}


def test_payloads_tokens_code_and_uploads(spark, tmp_path):
    from ledgermatch.functions import hashing, text
    from ledgermatch.sources import xlsx

    cases = {'{"a":1,"b":"x"}': True, "{}": True, '{"a":[1]}': False, '{"a":{"b":1}}': False, "[1]": False, "x": False, None: False, '{"a":"' + "x" * 8000 + '"}': False}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    assert [r[0] for r in df.select(hashing.valid_payload(F.col("x"))).collect()] == list(cases.values())
    words = spark.createDataFrame([("El camión, 123 de Ñandú!",), (None,)], "x string").select(text.tokens(F.col("x"), ("camión",))).collect()
    assert [r[0] for r in words] == [["ñandú"], []]
    (tmp_path / "a.py").write_text("1")
    before = hashing.code_hash(tmp_path)
    (tmp_path / "a.py").write_text("2")
    assert before != hashing.code_hash(tmp_path)
    files = spark.createDataFrame([("d/a.xlsx", b"PK11"), ("d/a.csv", b"PK11"), ("d/a.xlsx", b"x"), ("d/a.xlsx", b"PK" * 20), ("d/;.xlsx", b"PK")], "p string, c binary")
    assert [r[0] for r in files.select(xlsx.upload_error(F.col("p"), F.col("c"), 30)).collect()] == [None, "not an .xlsx file", "not a workbook", "too large", "file name"]


def test_model_package(spark, tmp_path):
    import pytest

    from ledgermatch.operators import model

    rows = spark.createDataFrame([(float(i), "a" if i % 2 else " ", f"l{i % 3}") for i in range(60)], "x double, s string, label string")
    fitted = model.fit(rows, ["x", "s"], width=16, rounds=2)
    model.save(fitted, spark, str(tmp_path), ["x", "s"])
    top = model.predict_top(model.load(spark, str(tmp_path), ["x", "s"]), rows, ["x", "s"]).first()["top"]
    assert len(top) == 3 and len({e["label"] for e in top}) == 3
    with pytest.raises(ValueError):
        model.load(spark, str(tmp_path), ["s", "x"])
