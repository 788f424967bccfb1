from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermatch.functions import dates, hashing, numbers, text


def run(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "f,cases",
    [
        (text.present, {None: None, " NaN ": None, "none": None, "NULL": None, "": None, "na": "na", " ": None}),
        (text.collapse, {"  a  b\t": "a b", "  ": None, None: None, "null": None}),
        (text.strip_marks, {"Ñandú Ç": "Nandu C", "ﬁn ½ ²": "fin 1⁄2 2", "é": "e", "ß": "ß", "Ａ": "A", "plain": "plain"}),
        (text.basic_text, {" Añó  X ": "Ano X", None: None}),
        (text.model_text, {"ÁB  c": "ab c"}),
        (text.alnum_key, {"FV-00 12/É": "fv0012e", "--": None, "N.U.L.L": "null"}),
        (text.tax_id, {"900123.0": "900123", "900.123-4": "9001234", "abc": None, " 12 ": "12", None: None}),
        (text.letter_prefix, {"fv12": "fv", "12fv": None}),
        (text.first_code, {" ;a; b": "a", ";;": None, None: None, "0112;x": "0112"}),
        (text.leading_code, {" ;a": None, "b ;c": "b", None: None}),
        (lambda c: text.last_chars(c, 4), {"fv0012": "0012", "12": "12", "nan": None}),
        (text.key_type, {"Application Response": "CUDE", "Acuse de recibo": "CUDE", "Factura": "CUFE", None: "CUFE"}),
        (text.spreadsheet_null, {"NA": None, "none": "none", "None": None}),
        (text.safe_file_name, {"a/b\\c d?.xlsx": "c_d_.xlsx"}),
        (numbers.engine_money, {"1.234,56": 1.23456, "$ 1,000 ": 1000.0, "x": None, "": None, "5 %": 5.0}),
        (numbers.listing_money, {"16.822,50": Decimal("16822.5000"), "1,234.5": Decimal("1234.5000"), "12,5": Decimal("12.5000"), "": None, "x": None}),
        (numbers.xml_decimal, {"19.00": Decimal("19"), "NaN": None, "1e3": None, "0.1234567890123456789": None, "123456789012345678901": None}),
        (numbers.flag, {"Sí": 1, "x": 1, "0": 0, "no": 0, None: 0, "2": 1, "<NA>": 0}),
        (dates.listing_date, {"28-09-2026": date(2026, 9, 28), "2026-09-28": date(2026, 9, 28), "28/09/2026": date(2026, 9, 28), "31-02-2026": None, "x": None}),
        (dates.listing_datetime, {"2026-09-28T10:11:12.345-05:00": datetime(2026, 9, 28, 10, 11, 12), "28-09-2026 10:11:12": datetime(2026, 9, 28, 10, 11, 12)}),
        (dates.ledger_date, {"2026/02/28": date(2026, 2, 28), "2026-02-28": date(2026, 2, 28), "28/02/2026": None}),
    ],
)
def test_cases(spark, f, cases):
    assert dict(zip(cases, run(spark, f, list(cases)))) == cases


def test_contains_key(spark):
    df = spark.createDataFrame([("facturafv12", "fv12", True), ("a", None, False), (None, "a", False), ("nan", "nan", False)], "t string, p string, e boolean")
    assert df.where(text.contains_key(F.col("t"), F.col("p")) != F.col("e")).count() == 0


def test_day_distance_floors_before_the_sign_goes(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 12), datetime(2026, 1, 3), 2), (datetime(2026, 1, 4, 12), datetime(2026, 1, 3), 1), (None, datetime(2026, 1, 3), None)], "a timestamp, b timestamp, e long")
    assert [r["d"] for r in df.select(dates.day_distance(F.col("a"), F.col("b")).alias("d")).collect()] == [2, 1, None]


def test_natural_order(spark):
    codes = ["10", "9", "a2", "a10", None, "A1", "09"]
    df = spark.createDataFrame([(c,) for c in codes], "c string").orderBy(text.natural_key(F.col("c")), "c")
    assert [r["c"] for r in df.collect()] == ["09", "9", "10", "A1", "a2", "a10", None]


def test_ratio_and_probability(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0), (2.0, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, 2.0]
    assert [r[0] for r in df.select(numbers.probability(F.col("a") / 3)).collect()][:2] == [Decimal("0.333333333333")] * 2


def test_headers():
    assert text.fold_header("Fecha emisi�n") == "fecha emisin" and text.fold_header("NIT Emisor:") == "nit emisor"
    assert text.fold_ledger_header("C. C_Código") == "CCCODIGO"
    assert text.snake_name("  Año (Fiscal) ") == "ano_fiscal"


def test_hashes(spark):
    df = spark.createDataFrame([(2, "b", None), (1, "a", 3)], "id int, s string, n int")
    rows = df.select(hashing.canonical_json({c: F.col(c) for c in ("s", "n", "id")}).alias("j")).collect()
    assert rows[0]["j"] == '{"id":2,"n":null,"s":"b"}'
    assert hashing.frame_hash(df, "id").first() == hashing.frame_hash(df.orderBy("id"), "id").first()
    assert hashing.frame_hash(df, "id").first()["hash"] != hashing.frame_hash(df.withColumn("s", F.lit("c")), "id").first()["hash"]
    assert hashing.frame_hash(df.limit(0), "id").first()["n"] == 0
    assert df.where(hashing.is_hex(F.sha2("s", 256), 64)).count() == 2 and df.where(hashing.is_hex(F.col("s"), 64)).count() == 0


def test_normalizers_are_idempotent(spark):
    import random

    rng = random.Random(0)
    values = ["".join(rng.choice("aB1 .-\tÉßﬁ½ ́xyz/0") for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    for f in (text.collapse, text.basic_text, text.model_text, text.alnum_key, text.tax_id):
        once = df.select(f(F.col("x")).alias("x"))
        assert once.where(~f(F.col("x")).eqNullSafe(F.col("x"))).count() == 0, f.__name__


def test_keys_compute_their_text_once(spark):
    df = spark.createDataFrame([(" \u00c1\ufb01  x ",), ("nan",), (None,), ("\u00df-1",)], "t string")
    assert [r[0] for r in df.select(text.alnum_key(F.col("t"))).collect()] == ["afix", None, None, "1"]
    plan = df.select(text.alnum_key(F.col("t")).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?U)\\s+") == 1


def test_white_space_is_the_unicode_one_on_plain_and_other_texts(spark):
    space = [chr(c) for c in range(0x3100) if chr(c) in text._SPACES]
    texts = [None, "", " ", "a b", "a  b", " a", "a ", "NULL", " nAn\u2003", "a\n", "na n", "\u200ba"] + [f"{s}a{s}{s}b{s}" for s in space]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    odd = df.where(~text.strip(F.col("t")).eqNullSafe(slow) | ~F.regexp_replace(F.col("t"), r"(?U)\s", "").eqNullSafe(F.translate("t", text._SPACES, "")))
    assert odd.count() == 0
    got = [r[0] for r in df.select(text.collapse(F.col("t"))).collect()]
    assert got[:12] == [None, None, None, "a b", "a b", "a", "a", None, None, "a", "na n", "\u200ba"] and set(got[12:]) == {"a b"}


def test_payload_values_are_looked_at_where_they_may_break_a_limit(spark):
    from ledgermatch.functions import hashing, rules

    nested, form = "FilaJson contiene estructuras o columnas demasiado largas.", "FilaJson no es JSON valido."
    cases = [
        ('{"Concepto":"[a] {b}"}', None), ('{"Concepto":{"a":"1"}}', nested), ('{"a":[1]}', nested), ("[[1]]", nested), ("[1]", None), ("{}", None), ("{", form), (" 1", form), (None, form),
        ('{"a":"%s"}' % ("x" * 4000), None), ('{"a":"%s"}' % ("x" * 4001), nested), ('{"a":"%s"}' % ("é" * 4000), None), ('{"a":"%s"}' % ("é" * 4001), nested), ('{"a":"%s"}' % ("\U0001f600" * 2001), nested),
    ]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(cases)], "i int, p string")
    assert [r[0] for r in df.orderBy("i").select(hashing.payload_error(F.col("p"))).collect()] == [e for _, e in cases]
    out = rules.movements_of_json(df, "p")
    assert [r["concepto"] for r in out.orderBy("i").collect()][:5] == ["[a] {b}", '{"a":"1"}', None, None, None]
    plan = out.select("error")._jdf.queryExecution().optimizedPlan().toString()
    assert "entries" not in plan and "StructField(Fecha,StringType" in plan and plan.count("_members") < 3 * len(rules.MEMBERS)
