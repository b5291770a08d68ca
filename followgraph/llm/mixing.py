"""Operator 4, mixing sources to target weights: entropy balancing.

Each source shall give a target number of words.  Among all rates per
document that meet the targets and are at most ``MOST``, the ones closest to
1 in relative entropy are ``min(MOST, exp(x * size / mean size))`` with one
multiplier ``x`` per source, the solution of a convex dual.  Newton steps,
kept inside a shrinking bracket, find all multipliers at once; each step is
one grouped sum over the table of distinct ``(source, size)``.

Rates become whole copies by rounding their running sum over the documents
of a source, in order of size class, so that what rounding adds in one
document is taken from one of nearly the same size.  The running sum is
taken in two levels (within parts of about ``PART`` documents, then over the
parts' totals), so no source is gathered in one task.

The words that rounding leaves over or short in a source are then passed on
from its largest documents to its smallest: as many copies as fit into
what is open are added (or taken away), the largest first, until the next
one would miss the target by more than it is missed now.  Sizes and how many
copies they can take decide; a step at least halves what is open.  A source
thus misses its target by at most half of the smallest document that can
still change, unless none can.

DataFrame operations only.  A null text has no words; the null source is a
source of its own and comes last.  Documents without words take none.
Repeated rows are separate documents.  Sources whose target is 3 times
their size take every document 3 times.  An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from followgraph.llm import scratch

MOST = 3.0
STEPS = 60
CLOSE = 1e-9
PART = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, docs, target`` from ``source, size``.

    Weights 1, 2, 3 repeat over the sources in code point order.  Raising a
    common level ``t``, a source gets ``weight * t`` until it is full at
    ``MOST`` times its size; the sources fill up in order of size by weight.
    One row per source goes through the windows here, no documents.
    """
    source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weighed = source.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    every = W.partitionBy()
    filling = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    full = F.lit(MOST) * F.col("source_size")
    # The level at which this source would fill up if all before it are full and all from it on are not.
    rest = (F.sum("source_size").over(every) - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = weighed.withColumn("level", rest).withColumn("fits", F.col("level") * F.col("weight") <= full)
    # The first source that is not filled sets the level of all after it.
    level = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("weight"), "level"))).over(every)["level"]
    target = F.when(F.col("fits"), F.col("weight") * level).otherwise(full)
    return levels.withColumn("level", level).select("source", "source_size", "docs", F.least(full, F.coalesce(target, full)).alias("target"))


def multipliers(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """``source, mean, x`` for the sources with words: the dual solution."""
    bars = scratch.keep(sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    ratio = F.col("target") / F.col("source_size")
    mean = F.col("source_size") / F.col("docs")
    state = goal.where("source_size > 0").select(
        "source",
        "target",
        mean.alias("mean"),
        # A source that takes all it can needs no search: every size reaches the limit.
        (ratio >= MOST * (1 - 1e-12)).alias("done"),
        F.when(ratio < 1, mean * F.log(ratio)).otherwise(F.lit(0.0)).alias("low"),
        F.when(ratio < 1, F.lit(0.0)).otherwise(mean * F.log(F.lit(MOST))).alias("high"),
        F.when(ratio >= MOST * (1 - 1e-12), mean * F.log(F.lit(MOST))).otherwise(F.log(ratio)).alias("x"),
    )
    state = scratch.keep(state, "multipliers")
    for _ in range(STEPS):
        tilted = F.exp(F.least(F.col("x") * F.col("size") / F.col("mean"), F.log(F.lit(MOST))))
        open_ = F.col("x") * F.col("size") / F.col("mean") < F.log(F.lit(MOST))
        tokens = F.col("n") * F.col("size") * tilted
        active = state.where("not done")
        sums = (
            bars.join(active.select(F.col("source").alias("s"), "x", "mean"), F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source")
            .agg(F.sum(tokens).alias("got"), F.sum(F.when(open_, tokens * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
            .select(F.col("source").alias("s"), "got", "slope")
        )
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        error = F.col("got") - F.col("target")
        low = F.when(error <= 0, F.col("x")).otherwise(F.col("low"))
        high = F.when(error > 0, F.col("x")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("x") - error / F.col("slope"))
        near = F.abs(error) <= CLOSE * F.col("target")
        stepped = joined.withColumns({"low2": low, "high2": high, "newton": newton}).withColumn(
            "next", F.when(F.col("newton") > F.col("low2"), F.when(F.col("newton") < F.col("high2"), F.col("newton")))
        )
        move = ~F.col("done") & ~near
        seen = Observation()
        after = stepped.select(
            "source",
            "target",
            "mean",
            (F.col("done") | near).alias("done"),
            F.when(move, F.col("low2")).otherwise(F.col("low")).alias("low"),
            F.when(move, F.col("high2")).otherwise(F.col("high")).alias("high"),
            F.when(move, F.coalesce("next", (F.col("low2") + F.col("high2")) / 2)).otherwise(F.col("x")).alias("x"),
        )
        state = scratch.keep(after.observe(seen, F.count_if(~F.col("done")).alias("open")), "multipliers")
        if not seen.get["open"]:
            break
    return state.select("source", "mean", "x")


def equal(left: list[str], right: list[str]) -> Column:
    """All these columns equal pairwise, nulls being equal."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def renamed(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``_`` after the names of ``columns``."""
    return df.withColumnsRenamed({c: f"{c}_" for c in columns})


def balanced(rounded: DataFrame, goal: DataFrame) -> DataFrame:
    """``rounded`` (``id, source, size, part, copies``) with the words open in
    each source passed on from large documents to small ones."""
    bars = rounded.where("size > 0").groupBy("source", "size").agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")
    )
    bars = scratch.keep(bars, "bars")
    got = bars.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    short = renamed(got, ["source"]).join(goal, equal(["source"], ["source_"])).select("source", (F.round("target").cast("long") - F.col("got")).alias("open"))
    state = short.where("open <> 0").select("source", F.signum("open").cast("int").alias("sign"), F.abs("open").alias("open"))
    state = scratch.keep(state, "open")
    can = renamed(bars, ["source"]).join(state.select("source", "sign"), equal(["source"], ["source_"]))
    can = scratch.keep(can.select("source", "size", F.when(F.col("sign") > 0, F.col("n") * int(MOST) - F.col("copies")).otherwise(F.col("copies")).alias("n")).where("n > 0"), "sizes")
    changes = []
    larger = W.partitionBy("source").orderBy(F.desc("size")).rowsBetween(W.unboundedPreceding, -1)
    while True:
        fitting = can.join(renamed(state, ["source", "sign"]), equal(["source"], ["source_"])).where("size <= open")
        before = F.coalesce(F.sum(F.col("n") * F.col("size")).over(larger), F.lit(0))
        many = F.least(F.col("n"), F.floor((F.col("open") - F.col("before")) / F.col("size")))
        taken = fitting.withColumn("before", before).where("before < open").withColumn("many", many).where("many > 0")
        seen = Observation()
        taken = scratch.keep(taken.select("source", "size", "many").observe(seen, F.count(F.lit(1)).alias("rows")), "changes")
        if not seen.get["rows"]:
            break
        changes.append(taken)
        used = renamed(taken.groupBy("source").agg(F.sum(F.col("many") * F.col("size")).alias("used")), ["source"])
        state = state.join(used, equal(["source"], ["source_"]), "left").select("source", "sign", (F.col("open") - F.coalesce("used", F.lit(0))).alias("open"))
        state = scratch.keep(state, "open")
        can = can.join(renamed(taken, ["source", "size"]), equal(["source", "size"], ["source_", "size_"]), "left")
        can = can.select("source", "size", (F.col("n") - F.coalesce("many", F.lit(0))).alias("n")).where("n > 0")
        can = scratch.keep(can, "sizes")
    # No size is left that fits; one document more where that brings the target nearer.
    last = can.groupBy("source").agg(F.min("size").alias("size")).join(renamed(state, ["source"]), equal(["source"], ["source_"]))
    changes.append(last.where("size < 2 * open").select("source", "size", F.lit(1).cast("long").alias("many")))
    every = changes[0]
    for more in changes[1:]:
        every = every.unionByName(more)
    every = renamed(every.groupBy("source", "size").agg(F.sum("many").alias("many")), ["source"])
    every = every.join(state.select("source", "sign"), equal(["source"], ["source_"])).select("source", "size", "many", "sign")
    every = scratch.keep(every, "changes")

    # The documents of a size that change: those with the smallest ids, part by part.
    free = F.when(F.col("sign") > 0, int(MOST) - F.col("copies")).otherwise(F.col("copies"))
    both = ["source", "size"]
    hit = rounded.join(renamed(every, both), equal(both, ["source_", "size_"])).drop("source_", "size_").withColumn("free", free)
    parts = hit.groupBy("source", "size", "part").agg(F.sum("free").alias("n"))
    earlier = W.partitionBy("source", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offset = renamed(parts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"), [*both, "part"])
    up_to = W.partitionBy("source", "size", "part").orderBy("id", "copies").rowsBetween(W.unboundedPreceding, -1)
    numbered = hit.withColumn("before", F.coalesce(F.sum("free").over(up_to), F.lit(0))).join(offset, equal([*both, "part"], ["source_", "size_", "part_"]))
    moved = F.greatest(F.lit(0), F.least("free", F.col("many") - F.col("before") - F.col("offset"))) * F.col("sign")
    changed = numbered.withColumn("copies", F.col("copies") + moved).select(rounded.columns)
    same = rounded.join(renamed(every.select(both), both), equal(both, ["source_", "size_"]), "left_anti")
    return same.unionByName(changed)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key`` with ``source, size, source_size, target, copies, taken`` of every row."""
    sizes = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), words(text).alias("size"))
    sizes = scratch.keep(sizes, "documents")
    goal = scratch.keep(targets(sizes), "targets")
    dual = multipliers(sizes, goal)
    known = goal.join(dual.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    known = known.select(F.col("source").alias("s"), "source_size", "target", "mean", "x")
    rate = F.when(F.col("size") > 0, F.exp(F.least(F.col("x") * F.col("size") / F.col("mean"), F.log(F.lit(MOST))))).otherwise(F.lit(0.0))
    rated = sizes.join(known, F.col("source").eqNullSafe(F.col("s"))).select(
        "id", "source", "size", "source_size", "target",
        F.least(rate, F.lit(MOST)).alias("rate"),
        # Sizes within a fifteenth of each other.
        F.floor(F.log2(F.col("size") + 1) * 10).alias("class"),
    )
    many = rated.groupBy("source", "class").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART)).alias("parts"))
    many = many.select(F.col("source").alias("s"), F.col("class").alias("c"), "parts")
    dealt = rated.join(many, F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c"))).drop("s", "c")
    rated = scratch.keep(dealt.withColumn("part", F.pmod(F.xxhash64("id", "size"), "parts")).drop("parts"), "rates")
    place = ["source", "class", "part"]
    # Sums of equal numbers in any order: rates are taken as whole 2 ** -40ths.
    unit = F.round(F.col("rate") * F.lit(float(1 << 40))).cast("long")
    totals = rated.groupBy(*place).agg(F.sum(unit).alias("sum"))
    earlier = W.partitionBy("source").orderBy("class", "part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"{c}_") for c in place], F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    same = F.col("source").eqNullSafe(F.col("source_")) & (F.col("class") == F.col("class_")) & (F.col("part") == F.col("part_"))
    up_to = W.partitionBy("source", "class", "part").orderBy("size", "id").rowsBetween(W.unboundedPreceding, 0)
    summed = rated.withColumn("unit", unit).withColumn("upto", F.sum("unit").over(up_to))
    run = summed.join(offsets, same).withColumn("after", F.col("upto") + F.col("offset"))
    half = F.lit(1 << 39)
    copies = F.shiftright(F.col("after") + half, 40) - F.shiftright(F.col("after") - F.col("unit") + half, 40)
    rounded = run.select("id", "source", "size", "source_size", "target", "part", copies.alias("copies"))
    out = balanced(scratch.keep(rounded, "rounded"), goal)
    return out.select(F.col("id").alias(key), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
