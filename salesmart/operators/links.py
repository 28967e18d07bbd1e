"""Sanity of product-code links: validity that overlaps, codes linked on, and circles of codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.ordering import ascending
from salesmart.operators.ranges import RANGE, TIE, ranged
from salesmart.sinks.scratch import stored

LINK = ["old_sku_id", "current_sku_id", "valid_from", "valid_to"]
OPEN_END = "9999-12-31"


def _end():
    return F.coalesce("valid_to", F.lit(OPEN_END).cast("date"))


def overlapping_links(links: DataFrame) -> DataFrame:
    """Links that start while an earlier one of the same old code is still in force.

    Links of a code go by start, end and new code; ``covered_to`` is the last day that those
    before the row cover, NULL where one of them has no end. Of equal links all but one are
    reported. Links without a code or a start, or that end before they start, are never in
    force and neither overlap nor are overlapped.

    A sweep over ranges of equal size: a range is handed, as one row at the head of its
    first code, how far the ranges before it reach in that code. A code that most links
    share is thus worked on by many tasks.
    """
    in_force = links.select(*LINK).filter(
        F.col("old_sku_id").isNotNull() & (F.col("valid_from") <= _end())
    )
    rows = ranged(in_force.withColumn("_end", _end()), ["old_sku_id", "valid_from", "_end", "current_sku_id"])
    before = Window.partitionBy("old_sku_id").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy("old_sku_id", RANGE)
        .agg(F.max("_end").alias("_end"))
        .withColumn("_end", F.max("_end").over(before))
        .filter(F.col("_end").isNotNull())
    )
    so_far = (
        Window.partitionBy(RANGE, "old_sku_id")
        .orderBy(F.col("_head").desc(), *ascending(["valid_from", "_end", "current_sku_id", TIE]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("_head", F.lit(0))
        .unionByName(carried.withColumn("_head", F.lit(1)), allowMissingColumns=True)
        .withColumn("_reach", F.max("_end").over(so_far))
        .filter((F.col("_head") == 0) & (F.col("valid_from") <= F.col("_reach")))
        .select(*LINK, F.nullif("_reach", F.lit(OPEN_END).cast("date")).alias("covered_to"))
    )


def successors(links: DataFrame) -> DataFrame:
    """``code, next``: of several links of a code that which starts last, ends last, is greatest."""
    latest = F.struct(F.col("valid_from"), _end().alias("end"), F.col("current_sku_id"))
    return (
        links.filter(F.col("old_sku_id").isNotNull() & F.col("current_sku_id").isNotNull())
        .groupBy(F.col("old_sku_id").alias("code"))
        .agg(F.max(latest).alias("_link"))
        .select("code", F.col("_link.current_sku_id").alias("next"))
    )


def link_chains(links: DataFrame) -> DataFrame:
    """Where each old code ends when links are followed on, one row per old code.

    ``status`` is ``direct`` (the new code is not itself old), ``chain`` (it is, and the end
    is ``n_steps`` links away), ``cycle`` (the code comes back to itself after ``n_steps``
    links) or ``into_cycle`` (it runs into such a circle). ``final_sku_id`` is the end of a
    chain, NULL in the last two cases; ``cycle_id`` is the least code of the circle.

    Pointer jumping: a round doubles how far each code looks, so a chain of n links takes
    log2(n) joins. A chain has a code at every distance from its end; a round in which no code
    gets to an end has only circles left. The joins are asked to merge sorted rows: a broadcast
    in each round would send all codes through the driver as often as there are rounds.
    """
    step = stored(successors(links), "successors")
    codes = step.select(F.col("code").alias("_old"))
    state = stored(
        step.hint("merge").join(codes, F.col("next") == F.col("_old"), "left").select(
            "code", F.col("next").alias("at"), F.lit(1).cast("long").alias("n_steps"),
            F.col("_old").isNotNull().alias("open"),
        ),
        "chains",
    )
    left, n_open = -1, state.filter("open").count()
    while n_open and n_open != left:
        further = state.select(F.col("code").alias("_at"), F.col("at").alias("_to"), "n_steps", "open")
        moved = (
            state.filter("open").alias("s").hint("merge")
            .join(further.alias("t"), F.col("s.at") == F.col("t._at"))
            .select("s.code", F.col("t._to").alias("at"), (F.col("s.n_steps") + F.col("t.n_steps")).alias("n_steps"), "t.open")
        )
        state = stored(state.filter("not open").unionByName(moved), "chains")
        left, n_open = n_open, state.filter("open").count()
    ended = state.filter("not open").select(
        F.col("code").alias("old_sku_id"),
        F.col("at").alias("final_sku_id"),
        "n_steps",
        F.when(F.col("n_steps") == 1, "direct").otherwise("chain").alias("status"),
        F.lit(None).cast("string").alias("cycle_id"),
    )
    if not n_open:
        return ended
    return ended.unionByName(_circles(step.hint("merge").join(state.filter("open").select("code"), "code"), n_open))


def _circles(step: DataFrame, number: int) -> DataFrame:
    """The codes of ``step``, all of which run into circles; there are ``number``.

    After as many links as there are codes every code stands on a circle, each code of a
    circle is reached by one, and the least code passed by it is the least of the circle.
    """
    ahead = step.select("code", F.col("next").alias("at"), F.col("next").alias("least"))
    looked = 1
    while looked < number:
        ahead = stored(ahead, "circles")
        further = ahead.select(F.col("code").alias("_at"), F.col("at").alias("_to"), F.col("least").alias("_least"))
        ahead = ahead.hint("merge").join(further, F.col("at") == F.col("_at")).select(
            "code", F.col("_to").alias("at"), F.least("least", "_least").alias("least")
        )
        looked *= 2
    ahead = stored(ahead, "circles")
    on_circle = stored(
        ahead.hint("merge").join(ahead.select(F.col("at").alias("code")).distinct(), "code", "left_semi").select(
            F.col("code").alias("at"), F.col("least").alias("cycle_id")
        ),
        "circles",
    )
    lengths = on_circle.groupBy("cycle_id").agg(F.count(F.lit(1)).alias("_length"))
    known = on_circle.hint("merge").join(lengths, "cycle_id").select("at", "cycle_id", "_length")
    in_circle = known.select(F.col("at").alias("code"), F.lit(True).alias("_on"))
    return (
        ahead.hint("merge")
        .join(known, "at")
        .hint("merge")
        .join(in_circle, "code", "left")
        .select(
            F.col("code").alias("old_sku_id"),
            F.lit(None).cast("string").alias("final_sku_id"),
            F.when(F.col("_on"), F.col("_length")).alias("n_steps"),
            F.when(F.col("_on"), "cycle").otherwise("into_cycle").alias("status"),
            "cycle_id",
        )
    )


def resolved_links(links: DataFrame) -> DataFrame:
    """One link per old code, to the end of its chain; codes that run into a circle have none.

    What ``staging.replace_sku`` is given where links may lead to codes that are old themselves.
    """
    ends = link_chains(links).filter(F.col("final_sku_id").isNotNull())
    return ends.select("old_sku_id", F.col("final_sku_id").alias("current_sku_id"))
