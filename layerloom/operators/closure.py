"""Where the chains of a name ledger end, in a logarithmic number of joins.

Substitution follows no chain; this reports where following would lead. Every name points to its
representative. In each round a pointer takes the pointer of the name it points to, so after r rounds it is
2 ** r steps ahead. A name whose pointer still leads on when as many steps are made as there are names runs
into a cycle; then the pointer lies on it, and the smallest name among its next steps is the cycle's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension
from layerloom.functions.tasks import kept
from layerloom.operators.name_search import one_per_name


def ledger_closure(ledger: DataFrame) -> DataFrame:
    """``name``, ``end_name``, ``depth`` and ``in_cycle`` of every ledger name.

    ``end_name`` is the name the chain ends at, ``depth`` its steps. A chain into a cycle has no depth, and the
    smallest name of the cycle as its end. A name that stands for itself ends there, in no step. Of rows alike
    in name the one with the smallest representative counts.
    """
    usable = one_per_name(ledger.filter("representative IS NOT NULL"), ["representative"])
    ends = usable["representative"] == usable["name"]
    # low: the smallest name among the pointer's start and the steps before its end. open: the end leads on.
    state = kept(usable.select(
        "name", F.col("representative").alias("to"), F.when(ends, 0).otherwise(1).cast("bigint").alias("steps"),
        F.col("name").alias("low"), (~ends).alias("open"),
    ))
    names, made = state.count(), 1
    while True:
        step = state.select(F.col("name").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("low").alias("_low"), F.col("open").alias("_open"))
        asked = state.filter("open")
        # Popular ends are looked up once each.
        found = step.join(asked.select("to").distinct(), "to", "left_semi")
        on = join_dimension(asked, found, ["to"], "left", salt_by=["name"])
        known = F.col("_to").isNotNull()
        moved = on.select(
            "name", F.coalesce("_to", "to").alias("to"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.least("low", F.coalesce("_low", "low")).alias("low"), (known & F.coalesce("_open", F.lit(False))).alias("open"),
        )
        state = kept(state.filter("NOT open").unionByName(moved))
        made *= 2
        left = state.filter("open").count()
        if not left or made >= 2 * names:
            break
    # What is open now points into a cycle: the pointer's own steps have gone around it.
    cycles = state.select(F.col("name").alias("to"), F.col("low").alias("_cycle"))
    on = join_dimension(state, cycles.join(state.filter("open").select("to").distinct(), "to", "left_semi"), ["to"], "left", salt_by=["name"])
    return on.select(
        "name", F.when(F.col("open"), F.col("_cycle")).otherwise(F.col("to")).alias("end_name"),
        F.when(~F.col("open"), F.col("steps")).alias("depth"), F.col("open").alias("in_cycle"),
    )
