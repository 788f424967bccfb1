"""Model packages, poison messages, repair batches, payload rows and reports."""

import datetime
import hashlib
import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import claims, commits, dataset, extraction, model, split, views
from ledgermatch.sources import package, sinks
from ledgermatch.streaming import ingest


def write(path, entries):
    with tarfile.open(path, "w:gz") as archive:
        for name, content in entries:
            info = tarfile.TarInfo(name)
            if isinstance(content, str):
                info.type, info.linkname = tarfile.SYMTYPE, content
                archive.addfile(info)
            else:
                info.size = len(content)
                archive.addfile(info, io.BytesIO(content))
    return hashlib.sha256(path.read_bytes()).hexdigest()


def test_a_package_is_verified_and_loaded(spark, tmp_path):
    rows = spark.createDataFrame([(i, str(i % 3), "abc"[i % 3]) for i in range(60)], "xml_id long, nit string, label string")
    fitted = model.fit(rows, ["nit"], width=16, rounds=5)
    fitted.write().overwrite().save(str(tmp_path / "saved"))
    manifest = package.manifest_of(7, 3, ["nit"], "label")
    files = [(os.path.relpath(os.path.join(d, f), tmp_path / "saved"), os.path.join(d, f)) for d, _, names in os.walk(tmp_path / "saved") for f in names]
    entries = [(f"model/{name}", open(at, "rb").read()) for name, at in files] + [("manifest.json", json.dumps(manifest).encode())]
    path = tmp_path / "p.tar.gz"
    sha = write(path, entries)
    loaded, found = package.load_package(spark, str(path), sha, str(tmp_path / "out"), 7, ["nit"])
    assert found == manifest
    both = [sorted(map(tuple, model.predict_top(m, rows, ["nit"]).select("xml_id", "top").collect())) for m in (fitted, loaded)]
    assert both[0] == both[1]
    for kind, error in ((dict(client=8), "client"), (dict(features=["other"]), "features"), (dict(label="x"), "target")):
        with pytest.raises(ValueError, match=error):
            package.load_package(spark, str(path), sha, str(tmp_path / "out"), **({"client": 7, "features": ["nit"]} | kind))
    with pytest.raises(Exception, match="SHA-256"):
        package.members(spark, str(path), "0" * 64).collect()
    with pytest.raises(Exception, match="size of the package"):
        package.members(spark, str(path), sha, largest=10).collect()
    with pytest.raises(Exception, match="unpacks to more"):
        package.members(spark, str(path), sha, unpacked=100).collect()


@pytest.mark.parametrize("entries", [[("../x", b"1")], [("/x", b"1")], [("a/../../x", b"1")], [("x", "target")], [("a", b"1"), ("./a", b"2")], [("c:x", b"1")]])
def test_unsafe_members_are_refused(spark, tmp_path, entries):
    sha = write(tmp_path / "p.tar.gz", [("ok", b"1"), *entries])
    with pytest.raises(Exception, match="the package has"):
        package.members(spark, str(tmp_path / "p.tar.gz"), sha).collect()


def test_manifest_of_another_environment():
    manifest = package.manifest_of(1, 2, ["a"], "label")
    assert package.incompatible(manifest, 1, ["a"], "label") == []
    manifest["versions"] |= {"python": "3.1.0", "numpy": None}
    manifest["dataset_version"] |= {"id": 0, "contract": 2}
    assert package.incompatible(manifest, 1, ["a"], "label") == ["contract", "dataset version", "python", "numpy"]


def test_a_message_is_poison_once_across_restarts(spark, tmp_path):
    source, out, check = str(tmp_path / "in"), str(tmp_path / "dead"), str(tmp_path / "check")
    schema = "message_id string, value string, failed boolean, at int"

    def deliver(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        ingest.dead_letters(ingest.poison(ingest.read_folder(spark, source, schema)), out, check).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema("message_id string, value string, deliveries int").parquet(out).collect())

    assert deliver(*[("a", "x", True, i) for i in range(3)], ("b", "y", True, 1)) == []
    assert deliver(("a", "x", True, 3), *[("b", "y", i != 3, i) for i in range(2, 7)], ("c", "z", None, 1)) == []
    assert deliver(("a", "x", True, 4), ("a", "x", True, 5)) == [("a", "x", 5)]
    assert deliver(("a", "x", True, 6), ("b", "y", True, 7), ("b", "y", True, 8)) == [("a", "x", 5), ("b", "y", 5)]
    assert deliver(("a", "x", True, 7)) == [("a", "x", 5), ("b", "y", 5)]


def repair_frames(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    return (
        frame([(i, 1, 7, "ERROR") for i in range(1, 7)] + [(7, 2, 7, "ERROR"), (8, 1, 7, "PROCESADO")], "document_id long, client_id int, load_id int, state string"),
        frame([(i, i, 1, "ERROR", "xml" if i == 2 else "config") for i in range(1, 9)] + [(3, 30, 2, "ERROR", "config")], "document_id long, attempt_id long, attempt int, state string, error string"),
        frame([(i, i, i != 4) for i in range(1, 9)], "document_id long, version_id long, is_current boolean"),
        frame([(i, i, 7, "RECHAZADO" if i == 5 else "NUEVO") for i in range(1, 9)], "document_id long, version_id long, load_id int, outcome string"),
        frame([(6, True), (1, False)], "document_id long, is_current boolean"),
    )


@pytest.mark.parametrize("bound", [10_000, 3])
def test_a_repair_batch_is_all_or_nothing(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(claims, "TARGETS", bound)
    tables = repair_frames(spark)
    targets = spark.createDataFrame([(i, i, i) for i in range(1, 10)] + [(9, 9, 9)], "document_id long, attempt_id long, version_id long")
    judged = claims.repairable(targets, *tables, client=1, load_id=7)
    got = sorted((r["document_id"], r["problem"]) for r in judged.collect())
    assert got == [(1, None), (2, "attempt"), (3, "tried again"), (4, "version"), (5, "no valid row"), (6, "has XML"), (7, "document"), (8, "document"), (9, "twice"), (9, "twice")]
    assert {r["problem"]: r["n"] for r in claims.repair_report(judged).collect()}[""] == 1
    root = str(tmp_path)
    with pytest.raises(Exception, match="can't be repaired"):
        commits.commit(spark, root, "r1", claims.repair_effects(judged, 7, "me"))
    assert commits.read(spark, root, "states", "document_id long, state string").count() == 0
    good = claims.repairable(targets.where("document_id = 1"), *tables, client=1, load_id=7)
    assert commits.commit(spark, root, "r2", claims.repair_effects(good, 7, "me")) == commits.DONE
    assert [tuple(r) for r in commits.read(spark, root, "states", "document_id long, state string").collect()] == [(1, "PENDIENTE_DESCARGA")]
    assert json.loads(commits.read(spark, root, "messages", "document_id long, value string").first()["value"]) == {"schemaVersion": 1, "documentId": 1, "loadId": 7}


def test_payload_rows_are_typed_one_by_one(spark):
    row = {"documento_xml_id": 5, "version_extractor": "1", "cufe": "ab", "fecha_emision": "2026-01-02", "payable_amount": "1.5", "tiene_iva": True, "other": [1]}
    sent = [(1, json.dumps([row, row | {"documento_xml_id": "x", "payable_amount": {"a": 1}, "fecha_emision": "02/01/2026"}])), (2, "[]"), (3, '{"a": 1}'), (4, "["), (5, None)]
    out = [r for r in dataset.rows_of_json(spark.createDataFrame(sent, "batch int, rows_json string")).orderBy("batch", "untyped").collect()]
    assert [(r["batch"], r["xml_id"], r["untyped"]) for r in out] == [(1, 5, ""), (1, None, "documento_xml_id; fecha_emision; payable_amount"), (3, None, "json"), (4, None, "json"), (5, None, "json")]
    assert (out[0]["date"], float(out[0]["total"]), out[0]["tiene_iva"], out[0]["extractor_version"]) == (datetime.date(2026, 1, 2), 1.5, True, 1)


def test_compatibility_view_has_its_columns(spark):
    header = {c.split()[0]: None for c in extraction.HEADER.split(", ")} | {"extractorVersion": 1, "xmlType": "Invoice", "firstDescription": "d", "supplierName": "s", "ivaTotal": None}
    rows = spark.createDataFrame([(i, i, *header.values()) for i in (1, 2, 3)], extraction.TABLES["headers"]).withColumn("ivaTotal", F.lit("2.0").cast("decimal(38,18)"))
    documents = spark.createDataFrame([(1, True, "PROCESADO", None, 4), (2, True, "PROCESADO", "PENDIENTE", 4), (3, False, "PROCESADO", None, 4)], "xml_id long, is_current boolean, state string, review string, first_load_id long")
    view = views.compatibility_view(rows, documents)
    got = view.collect()
    assert len(view.columns) == len(set(view.columns)) == 34 and len(got) == 1
    assert (got[0]["id_carga"], got[0]["item1_proveedor"], got[0]["n_registros_sugeridos"], got[0]["tiene_inc"], got[0]["observaciones"]) == ("dian:4", "d - s", 3, 0, None)


def test_reports_are_ordered(spark, tmp_path):
    rows = spark.createDataFrame([(3, datetime.date(2026, 1, 1), "a", "train"), (1, datetime.date(2026, 3, 1), "b", "test"), (2, datetime.date(2026, 1, 1), "a", "train"), (4, datetime.date(2026, 1, 1), "z", "train")], "xml_id long, date date, label string, part string")
    report = split.partition_report(rows, split.trainable(rows.where("part = 'train'"), "label"))
    assert [(r["xml_id"], r["part"], r["trainable"]) for r in report.collect()] == [(1, "test", False), (2, "train", True), (3, "train", True), (4, "train", False)]
    sinks.report(report, str(tmp_path / "r"), order=["part", "xml_id"])
    assert [r["xml_id"] for r in spark.read.option("header", True).csv(str(tmp_path / "r")).collect()][:1] == ["1"]
