"""Commits over several tables, extraction registration, publication checks, lookups, reviews and repeated rows."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import commits, dataset, extraction, predictions, registry

KEY = "ab" * 48
HEADER = {
    "extractorVersion": 1, "xmlType": "Invoice", "uuid": KEY.upper(), "issueDate": "2026-02-28", "lineCount": 2, "invoiceId": "FV1", "supplierNit": "900", "supplierName": "S", "customerNit": "901", "customerName": "C",
    "currency": "COP", **{a: "1.50" for a in extraction.AMOUNTS},
}
LINES = [{"ordinal": i, "lineId": str(i), "quantity": "1", "price": "2.5", "lineAmount": "2.5"} for i in (2, 1)]
DOCUMENTS = "xml_id long, document_id long, key string, is_current boolean, state string, review string, load_id long"


def payload(xml_id=1, lines=LINES, **changes):
    header = {k: v for k, v in (HEADER | changes).items() if v is not None}
    return (xml_id, json.dumps(header), json.dumps(lines))


def parsed(spark, *rows):
    return extraction.payloads(spark.createDataFrame(list(rows), "xml_id long, header_json string, lines_json string"))


def document(xml_id=1, key=KEY, current=True, state="XML_DESCARGADO", review=None):
    return (xml_id, xml_id + 100, key, current, state, review, 7)


def test_payload_members_are_broken_one_by_one(spark):
    bad_lines = [LINES[0] | {"price": "x"}, LINES[1] | {"lineId": ""}]
    rows = [
        payload(1), payload(2, xmlType="Order", payableAmount="1e3x"), payload(3, lines=bad_lines), payload(4, lineCount=3), payload(5, issueDate="28-02-2026", supplierName=""), payload(6, customerNit="9" * 21),
        (7, "[1]", "[]"), (8, "{", "[]"), (None, *payload()[1:]), payload(9, lines=[LINES[0], LINES[0]]), payload(10, extractorVersion={"a": 1}, legacyCharge=None), (11, None, None),
    ]
    got = {r["xml_id"]: r for r in parsed(spark, *rows).collect()}
    assert {k: r["errors"] for k, r in got.items()} == {
        1: "", 2: "xmlType; payableAmount", 3: "lines[0].lineId; lines[1].price", 4: "lines", 5: "issueDate; supplierName", 6: "customerNit", 7: "request", 8: "request", None: "request", 9: "lines",
        10: "extractorVersion; legacyCharge", 11: "request",
    }
    assert got[1]["header"]["uuid"] == KEY and got[1]["header"]["issueDate"] == datetime.date(2026, 2, 28) and float(got[1]["header"]["ivaTotal"]) == 1.5
    assert [x["ordinal"] for x in got[1]["lines"]] == [1, 2]


def test_outcomes_and_effects_of_a_batch(spark):
    rows = parsed(spark, payload(1), payload(1, currency="USD"), payload(2), payload(3), payload(4), payload(5), payload(6, currency=""))
    documents = spark.createDataFrame([document(1), document(2, key="cd" * 48), document(3, review="PENDIENTE"), document(4, state="PROCESADO"), document(5), document(6)], DOCUMENTS)
    known = lambda i: spark.createDataFrame([(i, 1)], "xml_id long, extractor_version smallint")
    out = extraction.resolve(rows, documents, known(4), known(5))
    got = sorted((r["xml_id"], r["outcome"], r["reason"], r["promoted"]) for r in out.select("xml_id", "outcome", "reason", "promoted").collect())
    assert got == [
        (1, "EXISTENTE", None, False), (1, "REGISTRADA", None, True), (2, "RECHAZADA", "not current or another key", False), (3, "REGISTRADA", None, False), (4, "EXISTENTE", None, False),
        (5, "RECHAZADA", "an error is registered", False), (6, "RECHAZADA", "payload", False),
    ]
    counts = {name: rows.count() for name, rows in extraction.effects(out).items()}
    assert counts == {"headers": 2, "lines": 4, "promotions": 1, "events": 1, "rejected": 3}
    event = extraction.effects(out)["events"].first()
    assert (event["document_id"], event["load_id"], event["from_state"], json.loads(event["detail"])) == (101, 7, "XML_DESCARGADO", {"documentoXmlId": 1, "versionExtractor": 1})


def test_a_lost_batch_leaves_nothing_and_a_second_run_one_copy(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    rows = spark.createDataFrame([payload(1), payload(2), payload(3, currency="")], "xml_id long, header_json string, lines_json string")
    documents = spark.createDataFrame([document(1), document(2), document(3)], DOCUMENTS)
    count = lambda table: commits.read(spark, root, table, extraction.TABLES[table]).count()

    def lost(resolved):
        return {**real(resolved), "events": real(resolved)["events"].withColumn("detail", F.raise_error(F.lit("the executor is gone")).cast("string"))}

    real = extraction.effects
    monkeypatch.setattr(extraction, "effects", lost)
    with pytest.raises(Exception, match="gone"):
        extraction.register(spark, root, "b1", rows, documents)
    assert (tmp_path / "store" / "lines").exists() and [count(t) for t in ("headers", "lines", "promotions", "events", "rejected")] == [0] * 5
    monkeypatch.setattr(extraction, "effects", real)
    assert extraction.register(spark, root, "b1", rows, documents) == commits.DONE
    assert extraction.register(spark, root, "b1", rows, documents) == commits.AGAIN
    assert [count(t) for t in ("headers", "lines", "promotions", "events", "rejected")] == [2, 4, 2, 2, 1]
    assert extraction.register(spark, root, "b2", rows, documents) == commits.DONE  # the same payloads in another batch
    assert [count(t) for t in ("headers", "lines", "promotions", "events", "rejected")] == [2, 4, 2, 2, 2]
    now = extraction.current_documents(documents, commits.read(spark, root, "promotions", extraction.TABLES["promotions"]))
    assert {r["xml_id"]: r["state"] for r in now.collect()} == {1: "PROCESADO", 2: "PROCESADO", 3: "XML_DESCARGADO"}


def test_errors_stick_and_extractions_win(spark, tmp_path):
    root = str(tmp_path)
    documents = spark.createDataFrame([document(1), document(2)], DOCUMENTS)
    rows = lambda *some: spark.createDataFrame(list(some), "xml_id long, header_json string, lines_json string")
    failed = spark.createDataFrame([(1, 1, "bad"), (1, 1, "again")], "xml_id long, extractor_version int, error string")
    assert extraction.register_failures(spark, root, "f1", failed) == commits.DONE
    extraction.register(spark, root, "b1", rows(payload(1), payload(2)), documents)
    assert [r["xml_id"] for r in commits.read(spark, root, "headers", extraction.TABLES["headers"]).collect()] == [2]
    extraction.register_failures(spark, root, "f2", spark.createDataFrame([(2, 1, "late")], "xml_id long, extractor_version int, error string"))
    assert [tuple(r) for r in commits.read(spark, root, "failures", extraction.TABLES["failures"]).collect()] == [(1, 1, "again")]


def test_two_attempts_of_a_batch_show_one(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1,)], "a int")

    def other(_):  # commits the same batch while the first attempt is still writing
        assert commits.commit(spark, root, "x", {"t": df}) == commits.DONE
        return df

    assert commits.commit(spark, root, "x", {"t": df, "u": other}) == commits.AGAIN
    assert commits.read(spark, root, "t", "a int").count() == 1 and commits.read(spark, root, "u", "a int").count() == 0
    assert commits.read(spark, root, "nothing", "a int").count() == 0


PUBLISHED = "xml_id long, extractor_version int, key string, state string, entry string, label string, date date, total double"
DAY = datetime.date(2026, 1, 2)


def published(i, **changes):
    row = {"xml_id": i, "v": 1, "key": f"{i:096x}", "state": "OK_UNICO", "entry": "e", "label": "l", "date": DAY, "total": 1.0} | changes
    return tuple(row.values())


def test_publication_is_checked_while_it_is_written(spark, tmp_path):
    identity = dict.fromkeys(dataset.IDENTITY, "x")
    frame = lambda *rows: spark.createDataFrame(list(rows), PUBLISHED)
    current = spark.createDataFrame([(i, 1, f"{i:096x}", DAY if i != 3 else None) for i in range(1, 5)], "xml_id long, extractor_version int, key string, date date")
    kinds = dataset.checked(frame(published(1), published(2, label=" "), published(3), published(4, date=datetime.date(2026, 1, 3)), published(9), published(1, key="0" * 96), published(4, state="SIN_MATCH"), published(2, total=None)), current)
    assert sorted((r["xml_id"], r["problem"]) for r in kinds.collect() if r["problem"]) == [(1, "another key"), (2, "contract"), (2, "contract"), (4, "another date"), (4, "contract"), (9, "not current")]
    at = str(tmp_path / "d")
    for rows, what in ((frame(published(1), published(9)), "not current"), (frame(published(1), published(1)), "repeated xml_id"), (frame(), "rows"), (frame(published(1), published(2), published(3)), "rows")):
        with pytest.raises(ValueError, match=what):
            dataset.publish(spark, rows, identity, at, current=current, universe=2)
    assert not list((tmp_path / "d" / "pending").iterdir()) and not (tmp_path / "d" / "manifest").exists()
    assert dataset.publish(spark, frame(published(1), published(3)), identity, at, current=current, universe=2) == ("PUBLICADA", 1)
    assert dataset.read_version(spark, at, 1).columns == [c.split()[0] for c in PUBLISHED.split(", ")]


def test_a_missing_source_fails_the_job(spark):
    rows = spark.createDataFrame([("AB", 1), ("cd", 2)], "key string, n int")
    sources = spark.createDataFrame([("ab", 10), ("CD", 20), ("ef", 30)], "key string, xml_id long")
    assert sorted(tuple(r) for r in dataset.must_find(rows, "key", sources, "key", ["xml_id"]).collect()) == [("AB", 1, 10), ("cd", 2, 20)]
    for wrong in (spark.createDataFrame([("zz", 1)], rows.schema), spark.createDataFrame([(None, 1)], rows.schema)):
        with pytest.raises(Exception, match="no source for"):
            dataset.must_find(wrong, "key", sources, "key", ["xml_id"]).collect()
    with pytest.raises(Exception, match="no source for"):
        dataset.must_find(rows, "key", sources.union(sources), "key", ["xml_id"]).collect()


def test_lookups_move_no_key_that_is_not_read(spark):
    digest = "0A" * 48
    rows = spark.createDataFrame([(digest, 1), ("abc", 2), ("Ñ-É", 3), ("", 4), ("6162", 5), ("ab", 6)], "key string, n int").repartition(2)
    sources = spark.createDataFrame([(digest.lower(), 10, "a"), ("ABC", 20, None), ("ñ-é", 30, "c"), ("", 40, "d"), ("6162", 50, "e"), ("AB", 60, "f")], "key string, xml_id long, tag string")
    found = dataset.must_find(rows, "key", sources, "key", ["xml_id", "tag"])
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(1, 10, "a"), (2, 20, None), (3, 30, "c"), (4, 40, "d"), (5, 50, "e"), (6, 60, "f")]
    left = found.drop("key")._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1].split("\n")[1]
    assert "n#" in left and " key#" not in left.split(" AS _own")[1] and "[key#" not in left
    for key, said in (("0B" * 48, "no source for " + "0b" * 48), ("X y", "no source for x y")):
        with pytest.raises(Exception, match=said):
            dataset.must_find(spark.createDataFrame([(key, 1)], rows.schema), "key", sources, "key", ["xml_id"]).collect()


def test_reviews_are_folded_in_order(spark):
    rows = [
        (1, 1, "PENDIENTE", None, None, None, None), (1, 2, "APROBADA", 4, None, "r", 5), (1, 3, "APROBADA", 2, None, "r", 5), (1, 4, "RECHAZADA", None, None, "r", 5),
        (2, 1, "CORREGIDA", None, " ", "r", 5), (2, 2, "CORREGIDA", None, "t", " ", 5), (2, 3, "CORREGIDA", None, "t", "r", 5), (2, 4, "OTHER", None, None, "r", 5), (3, 1, "RECHAZADA", 1, None, "r", 5), (3, 2, "RECHAZADA", None, None, "r", None),
    ]
    events = spark.createDataFrame(rows, "p int, seq int, state string, option int, corrected string, reviewer string, at int")
    out = predictions.review(events, ["p"], ["seq"])
    got = {(r["p"], r["seq"]): (r["before"], r["outcome"]) for r in out.collect()}
    open_, bad = "PENDIENTE", "INVALIDA"
    assert got == {
        (1, 1): (open_, "ILEGAL"), (1, 2): (open_, bad), (1, 3): (open_, "APLICADA"), (1, 4): ("APROBADA", "ILEGAL"), (2, 1): (open_, bad), (2, 2): (open_, bad), (2, 3): (open_, "APLICADA"), (2, 4): ("CORREGIDA", bad),
        (3, 1): (open_, bad), (3, 2): (open_, bad),
    }
    assert {r["p"]: r["state"] for r in predictions.review_state(out, ["p"]).collect()} == {1: "APROBADA", 2: "CORREGIDA", 3: "PENDIENTE"}


def test_repeated_rows_get_their_stored_result(spark):
    batch = spark.createDataFrame([(1, 1, "k", "a", 1), (1, 2, "k", "b", 2), (1, 2, "k", "zz", 3), (1, 3, "k", "a", 4)], "load_id int, row int, key string, hash string, n int")
    results = spark.createDataFrame([(1, 1, "RECHAZADO")], "load_id int, row int, outcome string")
    out = registry.register_rows(batch, results, ["n"], lambda rows: registry.resolve_movements(rows, ["key"], "hash", ["n"]))
    assert sorted((r["n"], r["outcome"], r["existing"]) for r in out.collect()) == [(1, "RECHAZADO", True), (2, "NUEVO", False), (3, "NUEVO", True), (4, "ID_CON_CONTENIDO_DISTINTO", False)]


def test_effect_values_read_each_payload_once(spark, small):
    """One parse of a payload's header and lines for all five tables, with the rows of ``effects``."""
    from ledgermatch.plans import registrations

    found = registrations.extraction_effects(spark, small)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json(") == 2
    out = extraction.effects(registrations._resolved(spark, small))
    counts = {r["tab"]: r["count"] for r in found.groupBy("tab").count().collect()}
    assert counts == {name: (rows.select("xml_id").distinct() if name == "lines" else rows).count() for name, rows in out.items()}


def test_compatibility_view_reads_each_payload_once(spark, small):
    from ledgermatch.plans import registrations

    assert registrations.compatibility_view(spark, small)._jdf.queryExecution().analyzed().toString().count("from_json(") == 2
