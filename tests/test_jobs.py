from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermatch import schemas
from ledgermatch.operators import claims, dataset, registry
from ledgermatch.plans import jobs, pipeline

D = date(2026, 3, 1)


def raw_invoice(i, nit="900.1", number="FV-123", day=D, payable=1000.0, **more):
    row = {"xml_id": i, "nit": nit, "invoice": number, "date": day, "payable": payable, "tax_inclusive": payable, "line_extension": payable, "iva": 0.0, "supplier_name": "Ácme"} | more
    return tuple(row.get(c.split()[0]) for c in schemas.INVOICES.split(", "))


def raw_movements(first, number, concept, amount, day=D, nit="9001", credit_account="220505"):
    rows = [("510505", amount, 0), (credit_account, 0, amount)]
    out = []
    for j, (account, debit, credit) in enumerate(rows):
        row = {"movement_id": first + j, "date": day, "doc_type": " fc ", "doc_number": number, "account": account, "third_id": nit, "concept": concept, "debit": Decimal(debit), "credit": Decimal(credit)}
        out.append(tuple(row.get(c.split()[0]) for c in schemas.MOVEMENTS.replace("(19,4)", "").split(", ")))
    return out


def frames(spark, invoices, movements):
    return spark.createDataFrame(invoices, schemas.INVOICES), spark.createDataFrame(movements, schemas.MOVEMENTS)


def test_run_of_the_golden_case(spark):
    run = pipeline.match_run(*frames(spark, [raw_invoice(1)], raw_movements(1, "100", "Factura FV 123", 1000, date(2026, 3, 2))))
    got = run.rows.first()
    assert got["state"] == "OK_UNICO" and got["target"] == ["220505_C", "510505_D"] and got["is_ok"] and got["over_2_units"] == 0
    trained = run.training().first()
    assert trained["label"] == "('220505_C', '510505_D')" and trained["xml_id"] == 1 and trained["nit"] == "9001"
    assert {r["account_nature"]: r["ratio"] for r in run.history.collect()} == {"510505_D": 1.0, "220505_C": 1.0}
    assert run.profile.count() == 2 and {r["metric"]: r["value"] for r in run.quality.collect()}["state_ok_unico"] == 1
    assert {r["column"]: r["action"] for r in run.audit().collect()}["state"] == "leak"
    assert [tuple(r) for r in jobs.validate(run, run.matches)["comparison"].collect()] == [("both", True, True, 1)]


def many(n=60):
    """Invoices over six months; the supplier tells the template."""
    invoices, movements = [], []
    for i in range(n):
        day, nit = date(2026, 1 + i % 6, 5), str(1000 + i % 3)
        invoices.append(raw_invoice(i, nit, f"FV{100000 + i}", day, 10.0 + i))
        movements += raw_movements(2 * i, str(i), f"FV{100000 + i}", 10 + i, day, nit, f"22050{i % 3}")
    return invoices, movements


def test_dataset_model_and_predictions(spark, tmp_path):
    invoices, movements = frames(spark, *many())
    at = str(tmp_path / "data")
    assert pipeline.generate_dataset(spark, invoices, movements, "c", "erp", at) == ("PUBLICADA", 1)
    assert pipeline.generate_dataset(spark, invoices, movements, "c", " ERP", at) == ("YA_EXISTE", 1)
    assert not list((tmp_path / "data" / "pending").iterdir())
    rows = dataset.read_version(spark, at, 1)
    assert rows.count() == 60
    got = jobs.train(spark, at, 1, str(tmp_path / "model"), max_months=1, recent_months=2, factor=2, width=64, rounds=10).first()
    assert got["n"] == 10 and got["accuracy"] == 1.0 and got["known_accuracy"] == 1.0 and got["majority_accuracy"] < 0.5
    new, _ = frames(spark, [raw_invoice(100 + i, str(1000 + i), f"X{i}") for i in range(3)], movements.limit(0).collect())
    new = new.withColumn("extracted_at", F.lit(datetime(2026, 7, 2)))
    h = "a" * 64
    identity = {"client_id": 1, "dataset_version": 1, "model_name": "m", "model_hash": h, "manifest_hash": h}
    schema = "xml_id long, extractor_version int, dataset_version int, model_name string, model_hash string, manifest_hash string, feature_hash string, top array<struct<label:string,probability:decimal(18,12)>>"
    stored = spark.createDataFrame([(100, 1, 1, "m", h, h, h, [])], schema)
    out = {r["xml_id"]: r for r in jobs.predict(spark, str(tmp_path / "model"), new, rows, stored, identity, datetime(2026, 7, 1)).collect()}
    assert sorted(out) == [101, 102] and out[101]["top"][0]["label"] == "('220501_C', '510505_D')" and {r["outcome"] for r in out.values()} == {"REGISTRADA"}


def test_sources_must_keep_their_contract(spark, tmp_path):
    invoices, movements = frames(spark, [raw_invoice(1), raw_invoice(1)], raw_movements(1, "1", "x", 1))
    with pytest.raises(ValueError):
        pipeline.generate_dataset(spark, invoices, movements, "c", "s", str(tmp_path))


def test_a_lost_publication_leaves_no_version(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "xml_id long, label string")
    rows.write.parquet(f"{tmp_path}/rows/version=1")
    identity = dict.fromkeys(dataset.IDENTITY, "x")
    assert dataset.publish(spark, rows, identity, str(tmp_path)) == ("PUBLICADA", 1) and dataset.read_version(spark, str(tmp_path), 1).count() == 1


def test_ledger_loads(spark):
    previous = spark.createDataFrame(
        [("c", "ERP", "i1", "e1", "h1", "s", "OK", 5, 1), ("c", "ERP", "i2", "e1", "h2", "s", "PARCIAL", 5, 2), ("c", "ERP", None, None, "h3", "s", "ERROR", None, 3), ("c", "ERP", "i4", "e1", "h4", "s", "PARCIAL", 5, 4)],
        "client string, source string, item string, etag string, hash string, sheet string, state string, expected long, load_id long",
    )
    registered = spark.createDataFrame([(1, 5), (2, 3), (4, 5)], "load_id long, n long")
    asked = [("erp ", "i1", "e1", "h1", "s"), ("ERP", "i1", "e1", "h9", "s"), ("ERP", "i2", "e1", "h2", "s"), ("ERP", None, None, "h3", "s"), ("ERP", "i4", "e1", "h4", "s"), ("ERP", None, None, "h1", "other"), ("X", "i1", "e1", "h1", "s")]
    requests = spark.createDataFrame([("c", *r) for r in asked], "client string, source string, item string, etag string, hash string, sheet string")
    out = {(r["source"], r["item"], r["hash"], r["sheet"]): (r["outcome"], r["load_id"]) for r in registry.start_ledger_loads(requests, previous, registered).collect()}
    assert out == {
        ("ERP", "i1", "h1", "s"): ("ARCHIVO_EXISTENTE", 1), ("ERP", "i1", "h9", "s"): ("CONFLICTO", 1), ("ERP", "i2", "h2", "s"): ("REINTENTO", 2), ("ERP", None, "h3", "s"): ("REINTENTO", 3),
        ("ERP", "i4", "h4", "s"): ("ARCHIVO_EXISTENTE", 4), ("ERP", None, "h1", "other"): ("CONFLICTO", 1), ("X", "i1", "h1", "s"): ("NUEVA_CARGA", None),
    }


def test_rows_to_come_leave_a_load_partial(spark):
    rows = spark.createDataFrame([("a", "NUEVO", D), ("b", "RECHAZADO", D)], "load string, outcome string, at date")
    expected = spark.createDataFrame([("a", 2), ("b", 1), ("c", 0)], "load string, expected long")
    states = lambda **k: {r["load"]: r["state"] for r in registry.load_counters(rows, "load", "at", expected, **k).collect()}
    assert states() == {"a": "PARCIAL", "b": "ERROR", "c": "ERROR"} and states(ledger=True) == {"a": "PARCIAL", "b": "PARCIAL", "c": "ERROR"}


def test_ends_of_attempts(spark):
    cases = [  # result, attempt, state of the attempt, of the document, has XML -> operation, outcome, document, retry
        (("OK", 1, "INICIADA", "CONSULTANDO_DIAN", True), ("FINALIZADA", "OK", "XML_DESCARGADO", False)),
        (("REINTENTO", 1, "INICIADA", "CONSULTANDO_DIAN", True), ("FINALIZADA", "OK", "XML_DESCARGADO", False)),
        (("OK", 1, "INICIADA", "CONSULTANDO_DIAN", False), ("FINALIZADA", "ERROR", "ERROR", False)),
        (("REINTENTO", 4, "INICIADA", "CONSULTANDO_DIAN", False), ("FINALIZADA", "REINTENTO", "PENDIENTE_DESCARGA", True)),
        (("REINTENTO", 5, "INICIADA", "CONSULTANDO_DIAN", False), ("FINALIZADA", "ERROR", "ERROR", False)),
        (("NO_ENCONTRADO", 1, "INICIADA", "CONSULTANDO_DIAN", False), ("FINALIZADA", "NO_ENCONTRADO", "NO_ENCONTRADO", False)),
        (("NO_ENCONTRADO", 1, "INICIADA", "PROCESADO", False), ("FINALIZADA", "ERROR", "PROCESADO", False)),
        (("NO_ENCONTRADO", 1, "INICIADA", "REQUIERE_REVISION", False), ("FINALIZADA", "NO_ENCONTRADO", "REQUIERE_REVISION", False)),
        (("ERROR", 1, "OK", "XML_DESCARGADO", True), ("YA_FINALIZADA", "OK", "XML_DESCARGADO", False)),
    ]
    ids = range(len(cases))
    asked = spark.createDataFrame([(i, cases[i][0][0]) for i in ids], "attempt_id long, result string")
    attempts = spark.createDataFrame([(i, i, cases[i][0][1], cases[i][0][2]) for i in ids], "attempt_id long, document_id long, attempt int, state string")
    documents = spark.createDataFrame([(i, cases[i][0][3]) for i in ids], "document_id long, state string")
    xml = spark.createDataFrame([(i,) for i in ids if cases[i][0][4]], "attempt_id long")
    out = {r["attempt_id"]: tuple(r)[2:] for r in claims.finish_attempts(asked, attempts, documents, xml).collect()}
    assert out == {i: cases[i][1] for i in ids}
