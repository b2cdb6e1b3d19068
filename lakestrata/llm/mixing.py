"""Mixing sources to target sizes by entropy balancing, with DataFrame operations only.

Size is the number of words.  Sources, in order of their names, have weights that repeat;
they share ``share`` times all words, and no source is taken more than ``cap`` times: what
exceeds that is dealt to the others by weight.

Each document gets a rate, the exponential tilt by its size that is nearest to equal rates
(least relative entropy) and meets its source's target: rate = cap / (1 + exp(-lambda * size /
mean size)).  The dual is convex with one unknown per source; Newton steps, bracketed, solve
it.  Each step sums over a histogram (source, size, count) of the whole table in exact
decimals, so reruns agree to the last bit.

Rates become copies: the whole part always, and one more copy for documents whose hashed
number lies below their fraction, moved by a threshold per source that a radix search sets
such that the source's words meet its target.  Equal rows have equal numbers, so those on the
threshold, however many, get second numbers by their place in the table and a second search.
The one document on that threshold gives as many words as are missing.

Defined cases: null text has size 0; a null source is a source of its own and the last;
equal rows on the threshold are filled one after the other, in an order that hangs on their place
(the words they give together do not); a source without words has target 0; an empty table
gives no rows.  For whole rows the table is read twice: its rows must come in the same
order, as those of a written table do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
STEPS = 100  # far more than Newton's method takes; then it is an error
SPREAD = 1 << 30  # hashed numbers are below this
LEVELS = (20, 10, 0)  # bits below each radix digit of a rank, 31 bits in all


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """(source, source_size, n, target) from (source, size, n): a row per source.

    The level at which weights are multiplied is that of the first source, in order of
    capacity by weight, whose capacity reaches it.  Windows here see a row per source.
    """
    per = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n")
    )
    listed = F.array(*[F.lit(w) for w in weights])
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_capacity = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    weighed = (
        per.withColumn("place", F.row_number().over(in_order) - 1)
        .withColumn("weight", F.get(listed, F.col("place") % len(weights)))
        .withColumn("capacity", F.col("source_size") * cap)
        .withColumn("fills_at", F.col("capacity") / F.col("weight"))
    )
    before = by_capacity.rowsBetween(Window.unboundedPreceding, -1)
    after = by_capacity.rowsBetween(0, Window.unboundedFollowing)
    level = (
        weighed.withColumn("all", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("filled", F.coalesce(F.sum("capacity").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("all") * share - F.col("filled")) / F.sum("weight").over(after))
        .withColumn("nth", F.row_number().over(by_capacity))
        .withColumn(
            "level",
            F.min(
                F.when(F.col("level") <= F.col("fills_at"), F.struct("nth", "level"))
            ).over(Window.partitionBy())["level"],
        )
    )
    return level.select(
        "source",
        F.col("source_size").cast("bigint").alias("source_size"),
        "n",
        F.coalesce(
            F.least("capacity", F.col("level") * F.col("weight")), F.col("capacity")
        ).alias("target"),
    )


def _rate(cap: float) -> Column:
    """The tilted rate of a document of its source; of a full source, the cap."""
    x = F.col("tilt") * F.col("size") / F.col("mean")
    return F.when(F.col("full"), F.lit(cap)).otherwise(cap / (1 + F.exp(-x)))


def solve(sizes: DataFrame, goals: DataFrame, cap: float = 2.0, steps: int = STEPS) -> DataFrame:
    """``goals`` with the tilt of each source: Newton's method on the dual, all sources at
    once, kept inside a bracket that every step tightens.  The state is a row per source."""
    state = materialize(
        goals.select(
            "*",
            (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("full"),
            F.greatest(F.col("source_size") / F.col("n"), F.lit(1e-9)).alias("mean"),
            F.lit(0.0).alias("tilt"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            F.lit(False).alias("done"),
        )
    )
    exact = "decimal(38,9)"
    for _ in range(steps):
        joined = sizes.join(
            state.select(F.col("source").alias("of"), "tilt", "mean", "full"),
            F.col("source").eqNullSafe(F.col("of")),
        )
        part = _rate(cap) / cap
        mass = F.col("size") * F.col("n")
        sums = joined.groupBy("of").agg(
            F.sum((mass * part * cap).cast(exact)).cast("double").alias("value"),
            F.sum((mass * F.col("size") / F.col("mean") * part * (1 - part) * cap).cast(exact))
            .cast("double")
            .alias("slope"),
        )
        gap = F.col("value") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.greatest(F.col("slope"), F.lit(1e-300))
        inside = (F.col("low1").isNull() | (newton > F.col("low1"))) & (
            F.col("high1").isNull() | (newton < F.col("high1"))
        )
        beyond = (
            F.when(F.col("high1").isNull(), F.col("low1") * 2 + 1)
            .when(F.col("low1").isNull(), F.col("high1") * 2 - 1)
            .otherwise((F.col("low1") + F.col("high1")) / 2)
        )
        done = F.col("full") | (F.abs(gap) <= F.greatest(F.lit(1e-6), F.col("target") * 1e-9))
        step = F.abs(newton - F.col("tilt")) <= 4 * (1 + F.abs("tilt"))
        state = materialize(
            state.join(sums, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("low1", low)
            .withColumn("high1", high)
            .select(
                "source",
                "source_size",
                "n",
                "target",
                "full",
                "mean",
                F.when(done, F.col("tilt"))
                .when(inside & step, newton)
                .otherwise(beyond)
                .alias("tilt"),
                F.col("low1").alias("low"),
                F.col("high1").alias("high"),
                done.alias("done"),
            )
        )
        if state.where(~F.col("done")).isEmpty():
            return state
    raise RuntimeError(f"a source did not meet its target in {steps} steps")


def _ranked(rows: DataFrame, solved: DataFrame, cap: float) -> DataFrame:
    """Adds whole (copies for certain) and rank (one more copy below a threshold)."""
    sure = F.least(F.floor("rate"), F.lit(int(cap) - 1)).cast("bigint")
    fraction = F.floor((F.col("rate") - F.col("whole")) * SPREAD).cast("bigint")
    hashed = F.pmod(F.xxhash64("doc_id", "of", "size"), F.lit(SPREAD))
    return (
        rows.join(
            solved.select(
                F.col("source").alias("of"), "source_size", "target", "tilt", "mean", "full"
            ),
            F.col("source").eqNullSafe(F.col("of")),
        )
        .withColumn("rate", _rate(cap))
        .withColumn("whole", sure)
        .withColumn("rank", hashed - fraction + SPREAD)
        .withColumn("second", F.pmod(F.xxhash64("at"), F.lit(2 * SPREAD)))
    )


def _wanted(ranked: DataFrame) -> DataFrame:
    """(of, left): the words a source wants beyond whole copies."""
    wanted = ranked.groupBy("of").agg(
        F.max("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("sure")
    )
    missing = F.greatest(F.round(F.col("target") - F.col("sure")), F.lit(0))
    return wanted.select("of", missing.cast("bigint").alias("left"))


def _thresholds(ranked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(of, bound, left): per source the rank at which the words wanted run out, and how many
    of them are left for rows of just this rank.  Three digits, each by one grouped sum."""
    state = materialize(wanted.select("of", "left", F.lit(0).cast("bigint").alias("bound")))
    above = 31
    for below in LEVELS:
        here = state.select(F.col("of").alias("s"), "left", "bound")
        digits = (
            ranked.select("of", "size", "rank")
            .join(here, F.col("of").eqNullSafe(F.col("s")))
            .where(F.shiftright("rank", above) == F.shiftright("bound", above))
            .groupBy("s", F.shiftright("rank", below).alias("digit"))
            .agg(F.sum("size").alias("words"), F.max("left").alias("left"))
        )
        upto = Window.partitionBy("s").orderBy("digit")
        # The first digit at which the words exceed what is left; else the last one.
        found = (
            digits.withColumn("until", F.sum("words").over(upto))
            .withColumn("over", F.col("until") > F.col("left"))
            .groupBy("s")
            .agg(
                F.coalesce(F.min(F.when(F.col("over"), F.col("digit"))), F.max("digit")).alias(
                    "digit"
                ),
                F.coalesce(
                    F.min(F.when(F.col("over"), F.col("until") - F.col("words"))),
                    F.max(F.col("until") - F.col("words")),
                ).alias("before"),
            )
        )
        state = materialize(
            state.join(found, F.col("of").eqNullSafe(F.col("s"))).select(
                "of",
                (F.col("left") - F.col("before")).alias("left"),
                F.shiftleft("digit", below).alias("bound"),
            )
        )
        above = below
    return state


def _with_bound(ranked: DataFrame, bounds: DataFrame, of: str) -> DataFrame:
    """Adds its source's bound and what is left there; NULL where the source has none."""
    held = bounds.withColumnRenamed("of", f"of_{of}")
    return ranked.join(held, F.col("of").eqNullSafe(F.col(f"of_{of}")), "left").drop(f"of_{of}")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    whole_rows: bool = False,
) -> DataFrame:
    """Per row of ``docs`` its doc_id, size, source_size, target, rate, copies (whole copies, the
    one on the threshold rounded) and taken (words, exact to its source's target).  With
    ``whole_rows``, all columns as the struct ``row`` and copies instead."""
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size_of(F.col("text")).alias("size"),
        held,
    )
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    slim = materialize(rows.select("doc_id", "source", "size", "at"))
    sizes = materialize(slim.groupBy("source", "size").agg(F.count("*").alias("n")))
    solved = solve(sizes, targets(sizes, weights, share, cap), cap)
    first = _ranked(slim, solved, cap)
    bounds = _thresholds(first, _wanted(first))
    on_first = _with_bound(first, bounds, "").where("rank = bound")
    seconds = on_first.select("of", "size", F.col("second").alias("rank"))
    last = _thresholds(seconds, bounds.select("of", "left")).select(
        "of", F.col("bound").alias("bound2"), F.col("left").alias("left2")
    )
    ranked = _ranked(rows if whole_rows else slim, solved, cap)
    ranked = _with_bound(_with_bound(ranked, bounds, ""), last, "2")
    on_rank = F.col("rank") == F.col("bound")
    below = (F.col("rank") < F.col("bound")) | (on_rank & (F.col("second") < F.col("bound2")))
    on = on_rank & (F.col("second") == F.col("bound2"))
    if whole_rows:
        extra = (F.col("size") > 0) & (below | (on & (F.col("left2") * 2 >= F.col("size"))))
        return ranked.select("row", (F.col("whole") + extra.cast("bigint")).alias("copies"))
    # Rows of one source and both its numbers: nearly always one.
    edge = Window.partitionBy("of").orderBy("doc_id", "size", "at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    part = F.least("size", F.greatest(F.col("left2") - F.col("earlier"), F.lit(0)))
    clear = ranked.where(~F.coalesce(on, F.lit(False))).withColumn(
        "more", F.when(below, F.col("size")).otherwise(F.lit(0))
    )
    at = (
        ranked.where(on)
        .withColumn("earlier", F.coalesce(F.sum("size").over(edge), F.lit(0)))
        .withColumn("more", part)
        .drop("earlier")
    )
    both = clear.unionByName(at)
    extra = (F.col("more") > 0) & (F.col("more") * 2 >= F.col("size"))
    out = [
        "doc_id",
        "size",
        "source_size",
        "target",
        "rate",
        (F.col("whole") + extra.cast("bigint")).alias("copies"),
        (F.col("whole") * F.col("size") + F.col("more")).cast("bigint").alias("taken"),
    ]
    return both.select(*out)


def take(mixed: DataFrame) -> DataFrame:
    """The mixed documents: each row as often as it has copies."""
    return mixed.where("copies > 0").select(
        F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")
    ).select("row.*")
