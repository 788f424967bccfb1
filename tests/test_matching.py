import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import audit, entries, history, matching

INVOICE = "nit string, invoice string, date date, total double"
MOVEMENT = "movement_id long, date date, doc_type string, doc_number string, account string, third_id string, concept string, debit decimal(19,4), credit decimal(19,4)"
D = date(2026, 3, 1)


def solve(spark, invoices, moves, **options):
    inv = spark.createDataFrame(invoices, INVOICE).withColumn("invoice_key", matching.invoice_key(F.col("nit"), F.col("invoice")))
    mov = [(i, m[0], "FC", m[1], m[2], m[3], m[4], *[None if x is None else __import__("decimal").Decimal(str(x)) for x in m[5:]]) for i, m in enumerate(moves)]
    ent = entries.entries(entries.invoice_movements(spark.createDataFrame(mov, MOVEMENT)))
    return {r["invoice_key"]: r for r in matching.resolve(matching.candidates(inv, ent, **options)).collect()}


def move(number, concept, debit=0, credit=0, account="510505", nit="1", day=D):
    return (day, number, account, nit, concept, debit, credit)


def test_golden_case(spark):
    got = solve(spark, [("1", "fv123", D, 1000.0)], [move("100", "Factura FV123", 1000, day=date(2026, 3, 2)), move("100", "Factura FV123", 0, 1000, "220505", day=date(2026, 3, 2))])["1|fv123"]
    assert got["state"] == "OK_UNICO" and got["account_natures"] == ["220505_C", "510505_D"] and got["score"] == 180.0
    assert got["reasons"] == "texto_exacto|nit|dias_10|valor_0.05"


def test_without_entry(spark):
    got = solve(spark, [("1", "fv1", D, 10.0)], [move("1", "x", 10, nit="2")])["1|fv1"]
    assert got["state"] == "SIN_MATCH" and got["score"] is None and got["reasons"] == "sin_candidatos" and got["candidates"] == 0


def test_several_entries(spark):
    got = solve(spark, [("1", "fv1234", D, 1000.0)], [move("2", "fv1234 a", 500), move("1", "fv1234 b", 490), move("3", "other", 7)])["1|fv1234"]
    assert got["state"] == "REVISION_MULTIASIENTO" and got["matched_entry"] == "2026|FC|1;2026|FC|2" and got["account_natures"] == [] and got["matched_amount"] == 990.0


@pytest.mark.parametrize("days,state", [(0, "OK_TEXTO"), (400, "REVISION_MANUAL")])
def test_exact_text_needs_a_gap(spark, days, state):
    # The exact hit has 135 + 20 - 20; far in time it falls to 95, and the plain one has 80.
    far = date.fromordinal(D.toordinal() + days)
    got = solve(spark, [("1", "fv123456", D, 100.0)], [move("1", "fv123456", 900, day=far), move("2", "x", 100)])["1|fv123456"]
    assert got["state"] == state


@pytest.mark.parametrize("concept,amount,state", [("z123456", 108, "OK_TEXTO"), ("z123456", 108.1, "OK_VALOR"), ("z23456", 106, "OK_TEXTO"), ("z23456", 106.1, "OK_VALOR"), ("z3456", 105, "OK_TEXTO"), ("z3456", 109.9, "OK_VALOR"), ("z3456", 111, "REVISION_MANUAL"), ("zz", 100, "REVISION_MANUAL")])
def test_suffix_rules(spark, concept, amount, state):
    got = solve(spark, [("1", "ab123456", D, 100.0)], [move("1", concept, amount), move("2", "other", 5000, day=date(2020, 1, 1))])["1|ab123456"]
    assert got["state"] == state


def test_one_candidate_without_text(spark):
    assert solve(spark, [("1", "fv9", D, 10.0)], [move("1", "zz", 10)])["1|fv9"]["state"] == "REVISION_MANUAL"


def test_missing_tax_ids_pair(spark):
    got = solve(spark, [(None, "fv77", D, 10.0)], [move("1", "fv77", 10, nit=None)])["|fv77"]
    assert got["state"] == "OK_UNICO" and "nit" not in got["reasons"].split("|")
    assert solve(spark, [(None, "fv77", D, 10.0)], [move("1", "fv77", 10, nit=None)], pair_missing=False)["|fv77"]["state"] == "SIN_MATCH"


def test_ties_go_to_the_first_entry(spark):
    got = solve(spark, [("1", "q", D, 10.0)], [move("b", "x", 10), move("a", "x", 10)])["1|q"]
    assert got["matched_entry"] == "2026|FC|a"


@pytest.mark.parametrize("total", [None, 0.0])
def test_total_null_or_zero(spark, total):
    got = solve(spark, [("1", "fv5", D, total)], [move("1", "fv5", 10)])["1|fv5"]
    assert got["difference"] is None and got["score"] == 155.0


def test_labels(spark):
    df = spark.createDataFrame([(["510505_D"],), (["a", "b"],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(entries.template_label(F.col("a"))).collect()] == ["('510505_D',)", "('a', 'b')", "()", "()"]


def test_entry_aggregates(spark):
    rows = [(2, D, "FC", "1", "11", "b", " y  z ", 1, 0), (1, D, "FC", "1", " 11", "a", "x", 0, 2), (3, None, "FC", "1", "22", None, "nan", 0, 0), (4, date(2026, 1, 1), "FC", "1", None, "c", "x", 1, 1)]
    df = spark.createDataFrame([(*r[:7], *map(__import__("decimal").Decimal, r[7:])) for r in rows], MOVEMENT)
    out = {r["entry_key"]: r for r in entries.entries(df).collect()}
    got = out["2026|FC|1"]
    assert got["third_id"] == "a" and got["concept"] == "x | y z" and got["lines"] == 3 and got["accounts"] == ["11"]
    assert got["account_natures"] == ["11_C", "11_D"] and got["amount"] == 3.0 and got["entry_date"] == date(2026, 1, 1)
    assert out["-1|FC|1"]["accounts"] == ["22"] and out["-1|FC|1"]["concept"] is None


def test_entries_are_dealt_once_as_lines(spark):
    """No lists are made before the shuffle, and one list is made in all."""
    one = lambda i, third, account: (i, D, "FC", "1", account, third, "x", *[__import__("decimal").Decimal(1)] * 2)
    df = spark.createDataFrame([one(1, "b", "2"), one(2, "a", "1"), one(3, "b", None), one(4, None, "1"), one(5, "a", "nan")], MOVEMENT)
    out = entries.entries(df)
    assert [(r["third_id"], r["accounts"], r["lines"]) for r in out.collect()] == [("a", ["1", "2"], 5)]
    plan = entries.entries(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("partial_collect") == 1 and "mode(" not in plan


def test_no_rows(spark):
    assert solve(spark, [], [move("1", "x", 1)]) == {} and solve(spark, [("1", "a", D, 1.0)], [])["1|a"]["state"] == "SIN_MATCH"


def test_match_in_tiles_is_resolution_of_all_candidates(spark):
    r = random.Random(5)
    nits, day = [None, "", "1", "2", "3"], lambda: r.choice([None, date.fromordinal(D.toordinal() + r.randrange(-60, 60))])
    invoices = [(r.choice(nits), r.choice([None, f"fv{r.randrange(40)}", f"{r.randrange(9999, 10020)}99"]), day(), r.choice([None, 0.0, float(r.randrange(1, 60))])) for _ in range(80)]
    amount = lambda: __import__("decimal").Decimal(r.randrange(0, 30))
    moves = [(i, day(), "FC", r.choice([None, str(r.randrange(60))]), r.choice(["11", "22"]), r.choice(nits[:4]), r.choice(["x", f"fv{r.randrange(40)}", f"{r.randrange(9999, 10020)}99", None]), amount(), amount()) for i in range(200)]
    invoices.append(("1", "multi12345", D, 30.0))
    moves += [(300 + i, D, "FC", str(300 + i), "11", "1", f"multi12345 {i}", *map(__import__("decimal").Decimal, (10, 0))) for i in range(3)]
    inv = spark.createDataFrame(invoices, INVOICE).withColumn("invoice_key", matching.invoice_key(F.col("nit"), F.col("invoice")))
    inv = inv.dropDuplicates(["invoice_key"])
    ent = entries.entries(spark.createDataFrame(moves, MOVEMENT)).localCheckpoint()
    for pair_missing in (True, False):
        want = sorted(map(str, matching.resolve(matching.candidates(inv, ent, pair_missing)).collect()))
        assert any("2026|FC|300;2026|FC|301;2026|FC|302" in x for x in want)
        for tile in (1, 3, 1000):
            assert sorted(map(str, matching.match(inv, ent, pair_missing, tile=tile).collect())) == want


def test_match_shuffles_no_candidates(spark):
    inv = spark.createDataFrame([("1", str(i), D, 1.0) for i in range(40)], INVOICE).withColumn("invoice_key", matching.invoice_key(F.col("nit"), F.col("invoice"))).localCheckpoint()
    ent = entries.entries(spark.createDataFrame([(i, D, "FC", str(i), "1", "1", "x", None, None) for i in range(50)], MOVEMENT)).localCheckpoint()
    written = lambda: sum(s.apply(i).shuffleWriteRecords() for s in [stages()] for i in range(s.size()))
    stages = lambda: spark._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    before = written()
    assert matching.match(inv, ent).count() == 40
    assert written() - before < 40 * 50


def test_scores_stay_within_their_bounds(spark, small):
    from ledgermatch.plans import adaptor

    low, high = adaptor.scored(spark, small).agg(F.min("score"), F.max("score")).first()
    assert -45 <= low < high <= 180


def lying_by_number(spark):
    """Movements dealt by number, and invoices: numbers recur in several years and types and hold "|", invoices share a key."""
    r = random.Random(3)
    moves = [(i, date(r.choice([2025, 2026]), 3, 1 + i % 9), r.choice(["FC", "NC"]), f"{i % 30}" + "|x" * (i % 7 == 0), r.choice(["11", "22 "]), str(i % 4), f"fv{i % 30 + 1000}", *[__import__("decimal").Decimal(r.randrange(9)) for _ in "dc"]) for i in range(200)]
    moves += [(300 + i, D, "FC", f"m{i}", "11", "9", "multi12345", *map(__import__("decimal").Decimal, (10, 0))) for i in range(3)]
    moves = spark.createDataFrame(moves, MOVEMENT).withColumn("entry_key", entries.entry_key(F.year("date"), F.col("doc_type"), F.col("doc_number")))
    inv = spark.createDataFrame([(str(i % 5), f"fv{i % 30 + 1000}", D, float(i % 11)) for i in range(90)] + [("9", "multi12345", D, 30.0)], INVOICE).withColumn("invoice_key", matching.invoice_key(F.col("nit"), F.col("invoice")))
    return moves.repartition("doc_number"), inv


def test_entries_and_counters_of_lines_that_lie_by_number(spark):
    """Same rows as of lines that are dealt anew, and same counters as of a row for each candidate."""
    moves, inv = lying_by_number(spark)
    want = entries.entries(moves).localCheckpoint()
    assert sorted(map(str, entries.entries(moves, dealt=True).collect())) == sorted(map(str, want.collect()))
    assert entries.entries(moves, dealt=True)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    flags = inv.select("invoice_key", *[F.lit(1).alias(c) for c in ("no_nit", "no_invoice", "has_discount", "has_charge", "over_2_units", "over_4_units", "over_27_units", "payable_mismatch")])
    scored = matching.candidates(inv, want)
    counted = [{x["metric"]: x["value"] for x in audit.quality_counters(flags, moves, moves, want, s, matching.match(inv, want), inv).collect()} for s in (scored, None)]
    assert counted[0] == counted[1] and counted[0]["candidates"] > 90


def test_keys_of_their_own_are_kept(spark):
    """Entries' keys need not be those of their year, type and number."""
    moves = [(i, D, "FC", str(i), "11", "1", f"multi12345 {i}", *map(__import__("decimal").Decimal, (10, 0))) for i in range(3)] + [(9, D, "FC", "9", "11", "2", "x", *map(__import__("decimal").Decimal, (1, 0)))]
    ent = entries.entries(spark.createDataFrame(moves, MOVEMENT)).withColumn("entry_key", F.when(F.col("doc_number") != "1", F.concat(F.lit("own"), "doc_number")).otherwise(F.col("entry_key"))).localCheckpoint()
    inv = spark.createDataFrame([("1", "multi12345", D, 30.0), ("2", "x", D, 1.0), ("3", "x", D, 1.0)], INVOICE).withColumn("invoice_key", matching.invoice_key(F.col("nit"), F.col("invoice")))
    got = matching.match(inv, ent, tile=2).collect()
    assert sorted(map(str, got)) == sorted(map(str, matching.resolve(matching.candidates(inv, ent)).collect()))
    assert {x["matched_entry"] for x in got} == {"own0;2026|FC|1;own2", "own9", None}


def test_histories_of_lines_that_lie_by_number(spark):
    """Same rows as by the entry's key."""
    moves, inv = lying_by_number(spark)
    once = inv.dropDuplicates(["invoice_key"])
    found = matching.match(once, entries.entries(moves)).localCheckpoint()
    rows = sorted(map(str, history.line_history(found, moves, once).collect()))
    assert len(rows) > 10 and sorted(map(str, history.line_history(found, moves, once, dealt=True).collect())) == rows
    alone = matching.match(once, entries.entries(moves), accepted_only=True, tile=2).localCheckpoint()
    states = {r["state"] for r in found.select("state").distinct().collect()}
    assert "REVISION_MULTIASIENTO" in states and states & {*matching.ACCEPTED}
    kept = found.where(matching.accepted(F.col("state"))).join(once.select("invoice_key", "nit", "total"), "invoice_key")
    assert sorted(map(str, alone.collect())) == sorted(map(str, kept.select(alone.columns).collect()))
    assert sorted(map(str, history.line_history(alone, moves, None, dealt=True).collect())) == sorted(map(str, history.line_history(alone, moves, None).collect())) == rows
