"""Invoice-to-entry candidates, their scores, and the resolution of each invoice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from .entries import entry_key

SUFFIXES = (6, 5, 4)

# Points and limits of the score.
TEXT_POINTS = (100.0, 75.0, 60.0, 45.0)
NIT_POINTS = 35.0
DAY_POINTS = ((10, 20.0), (30, 10.0), (45, 4.0))
DAY_LOSS, VALUE_LOSS = (0.2, 20.0), (20.0, 25.0)
VALUE_POINTS = ((0.05, 25.0), (0.08, 15.0), (0.10, 7.0))
MULTI_LIMIT, GAP = 0.02, 20.0
SUFFIX_LIMITS = {6: 0.08, 5: 0.06, 4: 0.05}
VALUE_LIMIT = 0.10
#: Entries of a tax id that ``match`` compares in one row.
TILE = 256
ACCEPTED = ("OK_UNICO", "OK_TEXTO", "OK_VALOR")


def _sides(invoices: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Invoices and entries with what is compared for each pair normalized once per side: texts, suffixes and instants."""
    left = {"_full": text.present(F.col("invoice"))} | {f"_last_{n}": text.last_chars(F.col("invoice"), n) for n in SUFFIXES} | {"_day": dates.micros(F.col("date"))}
    right = entries.select(
        F.col("third_id").alias("entry_nit"), "entry_key", "entry_year", "doc_type", "doc_number", "entry_date", text.present(F.col("concept_key")).alias("concept_key"), "amount", "accounts", "account_natures", "lines"
    )
    return invoices.withColumns(left), right.withColumn("_entry_day", dates.micros(F.col("entry_date")))


def _flags(entry: Callable[[str], Column]) -> dict[str, Column]:
    """Text hits of an invoice's row on an entry whose columns ``entry`` gives.  A text that holds a number holds its last four characters, so these are tested first."""
    inside = lambda key: F.coalesce(F.contains(entry("concept_key"), F.col(key)), F.lit(False))
    last = inside("_last_4")
    return {"hit_full": last & inside("_full"), "hit_6": last & inside("_last_6"), "hit_5": last & inside("_last_5"), "hit_4": last}


def _difference(amount: Column) -> Column:
    return F.when(F.col("total") != 0, F.abs(amount - F.col("total")) / F.abs(F.col("total")))


def candidates(invoices: DataFrame, entries: DataFrame, pair_missing: bool = True) -> DataFrame:
    """Each invoice with every entry of its tax id; invoices without one stay with null entry columns.

    Invoices and entries without a tax id pair too, as nulls compare equal here; that group is
    a product by its meaning, and ``pair_missing=False`` leaves it out.  The comparison is an
    equi-join on (value, is null), so adaptive execution can split a heavy supplier.
    """
    left, right = _sides(invoices, entries)
    same = F.col("nit").eqNullSafe(F.col("entry_nit"))
    joined = left.join(right, same if pair_missing else F.col("nit") == F.col("entry_nit"), "left")
    found = F.col("entry_key").isNotNull()
    joined = joined.withColumns(_flags(F.col))
    joined = joined.withColumns(
        {"hit": F.col("hit_4"), "days": F.when(found, dates.micro_days(F.col("_entry_day"), F.col("_day"))), "difference": F.when(found, _difference(F.col("amount")))}
    )
    joined = joined.drop("_full", *[f"_last_{n}" for n in SUFFIXES], "_day", "_entry_day")
    return joined.withColumns({"score": F.when(found, score()), "reasons": F.when(found, reasons())})


def _steps(value: Column, steps, loss: tuple[float, float]) -> Column:
    out = None
    for limit, points in steps:
        out = F.when(value <= limit, points) if out is None else out.when(value <= limit, points)
    return F.when(value.isNull(), 0.0).otherwise(out.otherwise(-F.least(value * loss[0], F.lit(loss[1]))))


def score(of: Callable[[str], Column] = F.col) -> Column:
    """Points for text, tax id, days and value, added from left to right; missing parts give none."""
    by_text = F.when(of("hit_full"), TEXT_POINTS[0])
    for n, points in zip(SUFFIXES, TEXT_POINTS[1:], strict=True):
        by_text = by_text.when(of(f"hit_{n}"), points)
    by_nit = F.when(F.col("nit") == F.col("entry_nit"), NIT_POINTS).otherwise(0.0)
    return by_text.otherwise(0.0) + by_nit + _steps(of("days"), DAY_POINTS, DAY_LOSS) + _steps(of("difference"), VALUE_POINTS, VALUE_LOSS)


def reasons() -> Column:
    """What speaks for or against a candidate, joined by "|"."""
    by_text = F.when(F.col("hit_full"), "texto_exacto")
    for n in SUFFIXES:
        by_text = by_text.when(F.col(f"hit_{n}"), f"texto_ultimos_{n}")

    def steps(value: Column, limits, name: str) -> Column:
        out = F.when(value.isNull(), None)
        for limit, _ in limits:
            out = out.when(value <= limit, f"{name}_{limit:g}")
        return out.otherwise(f"{name}_lejos")

    parts = F.concat_ws("|", by_text, F.when(F.col("nit") == F.col("entry_nit"), "nit"), steps(F.col("days"), DAY_POINTS, "dias"), steps(F.col("difference"), VALUE_POINTS, "valor"))
    return F.coalesce(F.nullif(parts, F.lit("")), F.lit("sin_evidencia"))


def _rank() -> list[Column]:
    """Best candidate first."""
    return [
        F.col("score").desc_nulls_last(), F.col("hit_full").desc(), F.col("hit_6").desc(), F.col("hit_5").desc(), F.col("hit_4").desc(),
        F.col("difference").asc_nulls_last(), F.col("entry_year").asc_nulls_last(), F.col("doc_type").asc_nulls_last(), F.col("doc_number").asc_nulls_last(),
    ]


def _adds_up() -> Column:
    """Do two or more text hits add up to the invoice's total?"""
    total = F.col("total")
    return F.coalesce((F.col("hits") >= 2) & (total != 0) & (F.abs(F.col("hit_amount") - total) / F.abs(total) <= MULTI_LIMIT), F.lit(False))


def resolve(scored: DataFrame, key: str = "invoice_key") -> DataFrame:
    """One row per invoice key: state, chosen entry or entries, score and gap to the runner-up.

    One window shuffle: counts and sums over the whole partition and the ranking share it.  Only the
    best candidate goes on, and the text hits of invoices whose hits add up to the total; these are
    listed by an aggregate on the same partitioning, so no candidate carries a list.
    Ties rank by entry year, type and number.
    """
    own = Window.partitionBy(key)
    rank = own.orderBy(*_rank())
    hit = F.col("hit")
    found = F.col("entry_key").isNotNull()
    ranked = scored.withColumns(
        {
            "place": F.row_number().over(rank),
            "next_score": F.lead("score").over(rank),
            "candidates": F.sum(found.cast("long")).over(own),
            "hits": F.sum(hit.cast("long")).over(own),
            "hit_amount": F.sum(F.when(hit, F.col("amount").cast("decimal(19,4)"))).over(own).cast("double"),
            "hit_date": F.min(F.when(hit, F.col("entry_date"))).over(own),
            "hit_lines": F.sum(F.when(hit, F.col("lines"))).over(own),
            "top_score": F.max("score").over(own),
        }
    )
    ranked = ranked.withColumn("multi", _adds_up())
    listed = F.when(F.col("multi") & hit, F.struct(F.col("entry_year").isNull().alias("n"), "entry_year", "doc_type", "doc_number", "entry_key"))
    best = F.first(F.when(F.col("place") == 1, F.struct(*[c for c in ranked.columns if c != key])), ignorenulls=True)
    ranked = ranked.where((F.col("place") == 1) | (F.col("multi") & hit)).groupBy(key).agg(best.alias("best"), F.collect_list(listed).alias("hit_keys")).select(key, "best.*", "hit_keys")
    return _outcome(ranked, key)


def match(invoices: DataFrame, entries: DataFrame, pair_missing: bool = True, key: str = "invoice_key", tile: int = TILE, accepted_only: bool = False) -> DataFrame:
    """What ``resolve`` finds among ``candidates``, without a row for each candidate.

    The entries of a tax id are cut into tiles of ``tile``.  An invoice meets each tile in one row, which
    keeps the tile's best entry, the score of its second best, and the number, sums and keys of its text
    hits; these rows alone are shuffled and ranked.  Adaptive execution can split the tiles of a heavy supplier.
    What follows from other columns is not moved: a key that ``entries.entry_key`` gives is written again at the end.

    ``accepted_only`` gives the accepted matches alone, with their invoice's nit and total, as histories read them; keys of
    several hits, which no accepted match names, are not moved then.
    """
    left, right = _sides(invoices.select(key, "nit", "invoice", "date", "total"), entries)
    entry = ("_own_key", "entry_year", "doc_type", "doc_number", "entry_date", "_entry_day", "concept_key", "amount", "lines")
    plain_key = lambda of: entry_key(of("entry_year"), of("doc_type"), of("doc_number"))
    right = right.withColumn("_own_key", F.when(~F.col("entry_key").eqNullSafe(plain_key(F.col)), F.col("entry_key"))).drop("_entry_day")
    # Lists that only the best entry gives on stand apart, so that a caller who doesn't read them moves none.
    apart = ("accounts", "account_natures")
    # Entries stand in the order that decides between equal candidates.
    order = [F.col(c).asc_nulls_last() for c in ("entry_year", "doc_type", "doc_number", "_own_key")]
    tiles = right.withColumn("_place", F.row_number().over(Window.partitionBy("entry_nit").orderBy(*order))).withColumn("_tile", F.floor((F.col("_place") - 1) / tile)).withColumn("_entry_day", dates.micros(F.col("entry_date")))
    placed = lambda of, value: F.transform(F.sort_array(F.collect_list(F.struct("_place", *of))), value)
    tiles = tiles.groupBy("entry_nit", "_tile").agg(
        placed(entry, lambda e: F.struct(*[e[c].alias(c) for c in entry])).alias("of"), *[placed([F.col(c).alias("own")], lambda e: e["own"]).alias(f"_{c}") for c in apart]
    )
    joined = left.join(tiles, F.col("nit").eqNullSafe(F.col("entry_nit")) if pair_missing else F.col("nit") == F.col("entry_nit"), "left")

    def judged(e: Column, i: Column) -> Column:
        """Text hits as bits, the better the higher; days and difference."""
        flag = lambda name, bit: F.when(flags[name], bit).otherwise(0)
        flags = _flags(lambda n: e[n])
        text_hits = F.when(flags["hit_4"], flag("hit_full", 8) + flag("hit_6", 4) + flag("hit_5", 2) + 1).otherwise(0)
        return F.struct(i.alias("i"), text_hits.alias("hits"), dates.micro_days(e["_entry_day"], F.col("_day")).alias("days"), _difference(e["amount"]).alias("difference"))

    def ranked_by(x: Column) -> Column:
        of = {"days": x["days"], "difference": x["difference"]} | {f"hit_{n}": x["hits"] >= bit for n, bit in (("full", 8), (6, 4), (5, 2), (4, 1))}
        return F.struct((-score(of.__getitem__)).alias("loss"), (-x["hits"]).alias("no_hits"), x["difference"].isNull().alias("no_difference"), x["difference"].alias("difference"), x["i"].alias("i"), x["days"].alias("days"))

    def summary(ranked: Column) -> Column:
        """The best entry of a tile, the score of the next one, and the text hits."""
        return F.transform(F.array(F.array_min(ranked)), lambda best: chosen(ranked, best))[0]

    def chosen(ranked: Column, best: Column) -> Column:
        hits = F.transform(F.filter(ranked, lambda x: x["no_hits"] < 0), lambda x: F.col("of")[x["i"]])
        listed = lambda e: F.struct(e["entry_year"].isNull().alias("n"), *[e[n].alias(n) for n in ("entry_year", "doc_type", "doc_number", "_own_key", "entry_date", "amount", "lines")])
        return F.struct(best.alias("best"), F.col("of")[best["i"]].alias("entry"), F.get(F.sort_array(ranked["loss"]), F.lit(1)).alias("second"), F.transform(hits, listed).alias("hits"))

    # One expression: what it binds on its way is not written into rows.
    found = F.transform(F.array(F.transform(F.transform("of", judged), ranked_by)), summary)[0]
    joined = joined.withColumns({"_t": F.when(F.col("of").isNotNull(), found), "_n": F.coalesce(F.size("of"), F.lit(0)).cast("long")})
    money, hits = "decimal(29,4)", F.col("_t.hits")
    rows = joined.select(
        key, "nit", "entry_nit", "total", *[F.col(f"_t.entry.{n}") for n in entry if n not in ("_entry_day", "concept_key")],
        *[F.get(f"_{c}", F.col("_t.best.i")).alias(c) for c in apart], (-F.col("_t.best.loss")).alias("score"), (-F.col("_t.second")).alias("_second"),
        *[F.coalesce((-F.col("_t.best.no_hits")).bitwiseAND(bit) > 0, F.lit(False)).alias(f) for f, bit in (("hit_full", 8), ("hit_6", 4), ("hit_5", 2), ("hit_4", 1))], F.col("_t.best.days"), F.col("_t.best.difference"), "_n",
        F.coalesce(F.size(hits), F.lit(0)).cast("long").alias("_n_hits"),
        F.aggregate(hits, F.lit(0).cast(money), lambda a, e: (a + F.coalesce(e["amount"].cast("decimal(19,4)"), F.lit(0))).cast(money)).alias("_hit_amount"),
        F.array_min(F.transform(hits, lambda e: e["entry_date"])).alias("_hit_date"), F.aggregate(hits, F.lit(0).cast("long"), lambda a, e: a + e["lines"]).alias("_hit_lines"),
        F.transform(hits, lambda e: F.struct(*[e[n].alias(n) for n in ("n", "entry_year", "doc_type", "doc_number", "_own_key")])).alias("_hit_keys"),
    )
    own = Window.partitionBy(key)
    rank = own.orderBy(*_rank())
    ranked = rows.withColumns(
        {
            "place": F.row_number().over(rank),
            "next_score": F.greatest("_second", F.lead("score").over(rank)),
            "candidates": F.sum("_n").over(own),
            "hits": F.sum("_n_hits").over(own),
            "hit_amount": F.sum("_hit_amount").over(own).cast("double"),
            "hit_date": F.min("_hit_date").over(own),
            "hit_lines": F.sum("_hit_lines").over(own),
            "top_score": F.max("score").over(own),
        }
    )
    ranked = ranked.withColumn("multi", _adds_up())
    if accepted_only:
        ranked = ranked.drop("_hit_keys").withColumn("_hit_keys", F.lit(None).cast(rows.schema["_hit_keys"].dataType))
    # The keys of hits matter only where they add up; of most invoices a row or none goes on.
    ranked = ranked.withColumn("hit_keys", F.when(F.col("multi"), F.flatten(F.collect_list(F.when(F.col("multi"), F.col("_hit_keys"))).over(own))))
    whole = lambda e: F.struct(*[e[n].alias(n) for n in ("n", "entry_year", "doc_type", "doc_number")], F.coalesce(e["_own_key"], plain_key(e.__getitem__)).alias("entry_key"))
    ranked = ranked.where("place = 1").withColumns({"hit_keys": F.transform("hit_keys", whole), "entry_key": F.when(F.col("_n") > 0, F.coalesce("_own_key", plain_key(F.col)))})
    ranked = ranked.withColumns({"hit": F.col("hit_4"), "reasons": F.when(F.col("entry_key").isNotNull(), reasons())})
    return _outcome(ranked, key, "nit", "total").where(accepted(F.col("state"))) if accepted_only else _outcome(ranked, key)


def _outcome(ranked: DataFrame, key: str, *more: str) -> DataFrame:
    """The state and the columns of a match from the best candidate of each invoice, its runner-up's score and the sums over its text hits."""
    hit, pct = F.col("hit"), F.col("difference")
    gap = F.col("score") - F.col("next_score")
    multi = F.col("multi")
    by_suffix = F.lit(False)
    for n, limit in SUFFIX_LIMITS.items():
        by_suffix = by_suffix | (F.col(f"hit_{n}") & F.coalesce(pct <= limit, F.lit(False)))
    state = (
        F.when(F.col("candidates") == 0, "SIN_MATCH")
        .when(multi, "REVISION_MULTIASIENTO")
        .when((F.col("candidates") == 1) & hit, "OK_UNICO")
        .when(F.col("hit_full") & (F.col("next_score").isNull() | (gap >= GAP)), "OK_TEXTO")
        .when(by_suffix, "OK_TEXTO")
        .when(hit & F.coalesce(pct <= VALUE_LIMIT, F.lit(False)), "OK_VALOR")
        .otherwise("REVISION_MANUAL")
    )
    is_multi = F.col("state") == "REVISION_MULTIASIENTO"
    keys = F.array_join(F.transform(F.array_sort("hit_keys"), lambda k: k["entry_key"]), ";")
    none = F.array().cast("array<string>")
    return ranked.withColumn("state", state).select(
        key,
        "state",
        F.when(is_multi, keys).otherwise(F.col("entry_key")).alias("matched_entry"),
        F.when(is_multi, F.col("top_score")).otherwise(F.col("score")).alias("score"),
        F.when(~is_multi, gap).alias("gap"),
        F.when(F.col("state") == "SIN_MATCH", "sin_candidatos").otherwise(F.col("reasons")).alias("reasons"),
        F.when(is_multi, F.col("hit_date")).otherwise(F.col("entry_date")).alias("matched_date"),
        F.when(is_multi, F.col("hit_amount")).otherwise(F.col("amount")).alias("matched_amount"),
        F.when(is_multi, F.col("hit_lines")).otherwise(F.col("lines")).alias("matched_lines"),
        F.when(is_multi, none).otherwise(F.col("accounts")).alias("accounts"),
        F.when(is_multi, none).otherwise(F.col("account_natures")).alias("account_natures"),
        "candidates",
        "hits",
        "days",
        "difference",
        *more,
    )


def invoice_key(nit: Column, invoice: Column) -> Column:
    """nit|invoice with nothing for nulls."""
    return F.concat(F.coalesce(nit, F.lit("")), F.lit("|"), F.coalesce(invoice, F.lit("")))


def accepted(state: Column) -> Column:
    return state.isin(*ACCEPTED)


def coverage(matches: DataFrame) -> DataFrame:
    """(state, n, pct): counts by state with their share of all invoices in percent, half to even."""
    counts = matches.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.bround(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def compare(mine: DataFrame, reference: DataFrame, key: str = "invoice_key") -> DataFrame:
    """Full outer comparison of two runs by key: where a key is, and whether state and entry agree."""
    a = mine.select(key, F.col("state").alias("state_a"), F.col("matched_entry").alias("entry_a"))
    b = reference.select(key, F.col("state").alias("state_b"), F.col("matched_entry").alias("entry_b"))
    both = a.join(b, key, "full_outer")
    side = F.when(F.col("state_a").isNull(), "right_only").when(F.col("state_b").isNull(), "left_only").otherwise("both")
    return both.withColumns({"side": side, "same_state": F.col("state_a").eqNullSafe(F.col("state_b")), "same_entry": F.col("entry_a").eqNullSafe(F.col("entry_b"))})


def line_distance(a: Column, b: Column) -> Column:
    return numbers.ratio(F.abs(a - b), F.abs(b))
