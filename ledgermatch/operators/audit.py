"""Column audits and quality summaries."""

from __future__ import annotations

from decimal import Decimal
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .matching import accepted

# Limits of the audit's actions, in the order in which they are tried.
NULLS, DOMINANT, DISTINCT, PAIR_COLUMNS = 0.95, 0.98, 0.80, 60


def column_audit(df: DataFrame, columns: list[str], leaks: tuple[str, ...] = ()) -> DataFrame:
    """Nulls, distinct values, dominant value and the action for each column.

    One scan unpivots the columns to (column, value) counts; values are counted before the
    shuffle, and the dominant one is the most frequent, ties to the smallest.
    """
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("c")).select("c.*")
    counts = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.when(F.col("value").isNotNull(), F.struct("n", F.lit(0)))).getField("n")
    stats = counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct"),
        best.alias("dominant_n"),
        F.min_by("value", F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value")))).alias("dominant"),
    )
    share = lambda n: F.bround(n / F.col("rows"), 4)
    stats = stats.withColumns({"null_share": share(F.col("nulls")), "dominant_share": share(F.coalesce("dominant_n", F.lit(0))), "distinct_share": share(F.col("distinct"))})
    action = (
        F.when(F.col("column").isin(*leaks), "leak")
        .when(F.col("distinct") <= 1, "constant")
        .when(F.col("null_share") >= NULLS, "nulls")
        .when(F.col("dominant_share") >= DOMINANT, "dominant")
        .when(F.col("distinct_share") >= DISTINCT, "high_cardinality")
        .otherwise("keep")
    )
    return stats.select("column", "rows", "nulls", "distinct", "dominant", "null_share", "dominant_share", "distinct_share", action.alias("action"))


def one_to_one(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b) of the column pairs, among the first 60, that map to each other one to one where neither is null."""
    pairs = list(combinations(columns[:PAIR_COLUMNS], 2))
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}`").cast("string").alias("x"), F.col(f"`{b}`").cast("string").alias("y")) for a, b in pairs])).alias("p")).select("p.*")
    seen = rows.where("x is not null and y is not null").distinct()
    wide = lambda side: seen.groupBy("a", "b", side).agg(F.count(F.lit(1)).alias("n")).groupBy("a", "b").agg(F.max("n").alias(f"per_{side}"))
    return wide("x").join(wide("y"), ["a", "b"]).where("per_x = 1 and per_y = 1").select("a", "b")


def long_form(summary: DataFrame) -> DataFrame:
    """One row of named counters as rows (metric, value)."""
    names = summary.columns
    return summary.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in names])).alias("m")).select("m.*")


def quality_summary(invoices: DataFrame, entries: DataFrame, scored: DataFrame, matches: DataFrame) -> DataFrame:
    """Counters (metric, value) over a match run; each input is read once."""

    def count_if(condition: Column) -> Column:
        return F.coalesce(F.count_if(condition), F.lit(0))

    a = invoices.agg(
        F.count(F.lit(1)).alias("invoices"),
        count_if(F.col("nit").isNull()).alias("invoices_without_nit"),
        count_if(F.col("invoice").isNull()).alias("invoices_without_number"),
        count_if(F.col("date").isNull()).alias("invoices_without_date"),
        count_if(F.col("total").isNull()).alias("invoices_without_total"),
    )
    b = entries.agg(F.count(F.lit(1)).alias("entries"), count_if(F.col("third_id").isNull()).alias("entries_without_nit"), F.coalesce(F.sum("lines"), F.lit(0)).alias("movements"))
    c = scored.agg(F.count(F.lit(1)).alias("candidates"), count_if(F.col("hit")).alias("candidates_with_text"))
    states = ("OK_UNICO", "OK_TEXTO", "OK_VALOR", "REVISION_MANUAL", "REVISION_MULTIASIENTO", "SIN_MATCH")
    d = matches.agg(*[count_if(F.col("state") == s).alias(f"state_{s.lower()}") for s in states])
    out = long_form(a)
    for part in (b, c, d):
        out = out.union(long_form(part))
    return out


def token_frequency_filter(docs: DataFrame, key: str, tokens: str, least: int = 2, share: float = 0.35) -> DataFrame:
    """(key, text, n): each document's tokens, in order, whose document frequency is at least ``least`` and at most max(1, floor(share x documents)), and their number.

    The share is taken as the decimal that it is written as.  Frequencies count keys, null not among them; an empty token is one like any other.
    """
    n = docs.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(Decimal(str(share))))).alias("most"))
    # Tokens move to their key's partition once, as arrays, for all that follows: pairs of key and token are told apart there, and only counts of tokens are shuffled for the frequencies.  Those of null keys are never used.
    owned = docs.select(key, F.when(F.col(key).isNotNull(), F.col(tokens)).alias("_tokens")).repartition(key)
    each = owned.select(key, F.posexplode("_tokens").alias("at", "token"))
    frequency = each.select("token", key).distinct().groupBy("token").agg(F.count(key).alias("df"))
    kept = frequency.crossJoin(F.broadcast(n)).where((F.col("df") >= least) & (F.col("df") <= F.col("most"))).select("token")  # n is one row
    found = each.join(kept, "token").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("t"))
    return owned.select(key).distinct().join(found, key, "left").select(key, F.array_join("t.token", " ").alias("text"), F.coalesce(F.size("t"), F.lit(0)).cast("long").alias("n"))




def item_tokens(docs: DataFrame, key: str, column: str, stop: tuple[str, ...] = (), least_length: int = 3, least: int = 2, share: float = 0.35) -> DataFrame:
    """(key, text): the words of a description without stop words, numbers, short words, and words of too few or too many documents."""
    words = docs.select(key, text.tokens(F.col(column), stop, least_length).alias("tokens"))
    return token_frequency_filter(words, key, "tokens", least, share)


def quality_counters(invoices: DataFrame, movements: DataFrame, fc: DataFrame, entries: DataFrame, scored: DataFrame | None, matches: DataFrame, rows: DataFrame) -> DataFrame:
    """The 18 counters (metric, value) of a run: invoices by flag, movements, entries, candidates, matches by outcome, dataset rows.

    ``invoices`` are those of ``features.invoice_features``; each input is read once.
    Without ``scored`` the candidates are those that the matches have counted.
    """
    n = F.count(F.lit(1))
    flags = {
        "invoices_without_nit": "no_nit", "invoices_without_number": "no_invoice", "invoices_with_discount": "has_discount", "invoices_with_charge": "has_charge", "invoices_over_2_units": "over_2_units",
        "invoices_over_4_units": "over_4_units", "invoices_over_27_units": "over_27_units", "invoices_payable_mismatch": "payable_mismatch",
    }
    count_if = lambda x: F.coalesce(F.count_if(x), F.lit(0))
    outcomes = {
        "matches": n, "matches_ok": count_if(accepted(F.col("state"))), "matches_in_review": count_if(F.col("state").contains("REVISION")), "matches_none": count_if(F.col("state") == "SIN_MATCH"),
    }
    if scored is None:
        found = [matches.agg(F.coalesce(F.sum("candidates"), F.lit(0)).alias("candidates"), *[c.alias(name) for name, c in outcomes.items()])]
    else:
        found = [scored.agg(count_if(F.col("entry_key").isNotNull()).alias("candidates")), matches.agg(*[c.alias(name) for name, c in outcomes.items()])]
    parts = [
        invoices.agg(n.alias("invoices"), *[count_if(F.col(c) == 1).alias(name) for name, c in flags.items()]),
        movements.agg(n.alias("movements")), fc.agg(n.alias("invoice_movements")), entries.agg(n.alias("entries")), *found,
        rows.agg(n.alias("dataset_rows")),
    ]
    out = long_form(parts[0])
    for part in parts[1:]:
        out = out.union(long_form(part))
    return out
