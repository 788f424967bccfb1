"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Sources in code-point order, null last, get the weights 5, 2, 1, 5, 2, 1, ...  They share
``share`` (150 %) of all words by weight; a target stops at ``cap`` (2) times its source's
words, and the excess goes to the others by weight until none is above.  With the sources
sorted by cap over weight that fill is a running sum over one row per source.

Within a source every document first gets the whole copies that are certain (the integer part
of target / words); the rest is drawn without replacement by Pareto order sampling: with a
uniform u from a seeded hash and the inclusion probability p, documents rank by
(u / (1 - u)) / (p / (1 - p)), and the first of that order are taken as far as they fit in
what is left of the target; one more document, from those near the cut, is taken if it comes
nearest to the rest.

A document's copies are expected in proportion to its inclusion weight, up to ``cap``: by
default ``BASE_WEIGHT`` + the binary logarithm of its words, so that longer documents are
likelier, or what ``weight_col`` holds.  Weights are rounded down to a 16th of an octave, so a source
has few different ones, and the level at which the capped expectations sum to the target
follows from running sums over these, largest first: what the cap cuts off goes to the others.

The cut of that order is found without sorting a source in one task: ranks are first summed
in about sqrt(n) / 4 bins by (source, bin); only the bin where the running sum passes the target
is put in order.  Equal rows are counted before any shuffle and numbered, so each copy has
its own draw.

Null and empty texts have size 0; they take part with 0 words.  Without words all targets
are 0.  The draw depends on doc_id, source, text and seed only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2.0, 8
BASE_WEIGHT = 2.0
KEYS = ["doc_id", "source", "size", "_k1", "_k2"]


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, target from rows (source, size): one row per source, null included."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    own = total.withColumn("w", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    own = own.withColumn("top", F.col("source_size") * cap)
    fill = Window.orderBy(F.col("top") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    own = own.withColumn("level", level).withColumn("full", F.col("top") <= F.col("level") * F.col("w"))
    # Once a source stays below its cap, all that follow do, at that source's level.
    first = F.min(F.when(~F.col("full"), F.struct(F.col("top") / F.col("w"), F.col("source").isNull(), "source", "level"))).over(Window.partitionBy())
    return own.select("source", "source_size", F.when(F.col("full"), F.col("top")).otherwise(F.col("w") * first["level"]).alias("target"))


def _null_safe(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def levels(steps: DataFrame, cap: float) -> DataFrame:
    """s, step, expected: the copies that a document of each weight step gets on average.

    ``steps`` has s (source), step, weight, words and target; the heaviest steps that reach the
    cap at the level of the rest get the cap.
    """
    heavy = Window.partitionBy("s").orderBy(F.desc("step"))
    before, rest = heavy.rowsBetween(Window.unboundedPreceding, -1), heavy.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("target") - cap * F.coalesce(F.sum("words").over(before), F.lit(0))
    mass = F.sum(F.col("weight") * F.col("words")).over(rest)
    own = steps.withColumn("level", F.when(mass > 0, left / mass).otherwise(0.0)).withColumn("full", F.col("level") * F.col("weight") >= cap)
    # Once a step stays below the cap all lighter ones do, at that step's level.
    first = F.max(F.when(~F.col("full"), F.struct("step", "level"))).over(Window.partitionBy("s"))
    return own.select("s", "step", F.when(F.col("full"), F.lit(float(cap))).otherwise(F.greatest(F.lit(0.0), F.col("weight") * first["level"])).alias("expected"))


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED, weight_col: str | None = None) -> DataFrame:
    """One row per document row: the keys, its source's size and target, and ``copies`` (how often the mix takes it).

    Null, negative and zero weights of ``weight_col`` are none: such a document isn't drawn.
    """
    size = common.word_count(F.col("text"))
    weight = F.coalesce(F.col(f"`{weight_col}`").cast("double"), F.lit(0.0)) if weight_col else BASE_WEIGHT + F.log2(size + 1.0)
    step = F.when((weight > 0) & (weight < float("inf")), F.floor(F.log2(weight) * 16)).otherwise(F.lit(-(1 << 20))).cast("int")
    sized = docs.select("doc_id", "source", size.alias("size"), *common.text_key(F.col("text")), step.alias("step"))
    counted = common.store(sized.groupBy(*KEYS, "step").agg(F.count(F.lit(1)).alias("n")), "sized")
    per_source = targets(counted.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, cap)
    mass = counted.groupBy("source").agg(F.sum("n").alias("rows")).select(F.col("source").alias("s"), "rows")
    sources = common.store(per_source.join(mass, _null_safe("source", "s")).drop("s"), "targets").withColumnRenamed("source", "s")
    in_steps = counted.groupBy("source", "step").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    in_steps = in_steps.join(sources.select("s", "target"), _null_safe("source", "s")).withColumn("weight", F.when(F.col("step") > -(1 << 20), F.pow(F.lit(2.0), F.col("step") / 16)).otherwise(0.0))
    share_of = common.store(levels(in_steps.select("s", "step", "weight", "words", "target"), cap), "levels").withColumnsRenamed({"s": "s2", "step": "step2"})
    rows = common.unfolded(counted, "n", "copy").drop("n")
    rows = rows.join(sources, _null_safe("source", "s")).drop("s").join(share_of, _null_safe("source", "s2") & (F.col("step") == F.col("step2"))).drop("s2", "step2", "step")

    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "source", "_k1", "_k2", "copy"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = rows.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole")).withColumn("u", u)
    # odds(u) / odds(p), as a number between 0 and 1; p = 0 goes last and is never taken.
    odds = F.col("u") * (1 - F.col("p")) / (F.col("u") * (1 - F.col("p")) + (1 - F.col("u")) * F.col("p"))
    bins = F.greatest(F.lit(1.0), F.ceil(F.sqrt(F.col("rows").cast("double")) / 4))
    rows = rows.withColumn("rank", F.when(F.col("p") > 0, odds).otherwise(1.0)).withColumn("bin", F.when(F.col("p") > 0, F.floor(F.col("rank") * bins)).otherwise(bins).cast("long"))

    sums = rows.groupBy("source", "bin").agg(F.sum(F.when(F.col("p") > 0, F.col("size")).otherwise(0)).alias("words"), F.sum(F.col("whole") * F.col("size")).alias("certain"), F.first("target").alias("target"))
    over, all_of = Window.partitionBy("source").orderBy("bin"), Window.partitionBy("source")
    sums = sums.select(F.col("source").alias("s"), F.col("bin").alias("b"), (F.sum("words").over(over) - F.col("words")).alias("start"), "words", (F.col("target") - F.sum("certain").over(all_of)).alias("left"))
    placed = rows.join(common.store(sums, "bins"), _null_safe("source", "s") & (F.col("bin") == F.col("b"))).drop("s", "b")
    placed = placed.withColumn("edge", (F.col("p") > 0) & (F.col("start") <= F.col("left")) & (F.col("start") + F.col("words") >= F.col("left")) & (F.col("words") > 0))
    out = ["doc_id", "source", "size", "_k1", "_k2", "copy", "source_size", "target", "whole"]
    clear = placed.where(~F.col("edge")).select(*out, F.when((F.col("p") > 0) & (F.col("start") + F.col("words") <= F.col("left")), 1).otherwise(0).alias("extra"))
    order = ["rank", "doc_id", "_k1", "_k2", "copy"]
    bin_of = Window.partitionBy("source", "bin")
    line = bin_of.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.where("edge").withColumn("through", F.col("start") + F.sum("size").over(line)).withColumn("first", F.col("through") <= F.col("left"))
    edge = edge.withColumn("rest", F.col("left") - F.coalesce(F.max(F.when(F.col("first"), F.col("through"))).over(bin_of), F.col("start")))
    fits = ~F.col("first") & (F.col("size") < 2 * F.col("rest"))
    edge = edge.withColumn("miss", F.when(fits, F.struct(F.abs(F.col("rest") - F.col("size")).alias("miss"), *order)))
    edge = edge.withColumn("last", F.coalesce(F.col("miss") == F.min("miss").over(bin_of), F.lit(False)))
    edge = edge.select(*out, F.when(F.col("first") | F.col("last"), 1).otherwise(0).alias("extra"))
    return clear.union(edge).withColumn("copies", F.col("whole") + F.col("extra")).drop("whole", "extra")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as many times as the plan takes it, with the columns of ``docs``."""
    taken = plan(docs, **options).groupBy("doc_id", "source", "_k1", "_k2").agg(F.sum("copies").alias("copies")).where("copies > 0")
    taken = taken.select(common.id_text("doc_id").alias("id"), common.id_text("source").alias("src"), "_k1", "_k2", "copies")
    key1, key2 = common.row_key(docs)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(key1.alias("r1"), key2.alias("r2")).alias("order"))
    keyed = keyed.select("row", "order", common.id_text("row.doc_id").alias("id"), common.id_text("row.source").alias("src"), *common.text_key(F.col("row.text")))
    # Rows that differ in other columns only are one document here: the first by a hash of all columns stands for them.
    once = keyed.join(taken, ["id", "src", "_k1", "_k2"]).groupBy("id", "src", "_k1", "_k2").agg(F.min_by("row", "order").alias("row"), F.first("copies").alias("copies"))
    return common.unfolded(once, "copies", "copy").select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return plan(common.read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
