"""A4 beyond gaps: the order of a page chain by pointer doubling.

Every page names its next.  In round k each page knows the page 2^k steps on,
so after log2(n) rounds of one self join the whole chain is ranked, however
long it is.  The pages reached from the head get their place on the way: a page
at place p gives the one 2^k steps on the place p + 2^k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def chain_order(pages: DataFrame, cur: str, nxt: str, head=None) -> DataFrame:
    """cur, nxt, place and kind of every page.

    `place` counts from 0 at the head (`head`, else the smallest page that none
    names as its next) and is NULL for pages the head doesn't lead to.  `kind`:
    `chain`, `end` (no next), `gap` (the next is no page), and of the pages not
    reached `cycle` (on one), `head` (nothing leads to it) or `unreached`.  A
    page listed twice counts once, with its smallest next."""
    p = cut_lineage(pages.select(F.col(cur).alias("cur"), F.col(nxt).alias("nxt")).where("cur is not null")
                    .groupBy("cur").agg(F.min("nxt").alias("nxt")))
    known = p.select(F.col("cur").alias("nxt"), F.lit(True).alias("there"))
    base = cut_lineage(p.join(known, "nxt", "left").select("cur", "nxt", F.when(F.col("there"), F.col("nxt")).alias("step")))
    named = base.where("step is not null").select(F.col("step").alias("cur")).distinct()
    heads = base.join(named, "cur", "left_anti").select("cur")
    n = base.count()
    start = base.where(F.col("cur") == F.lit(head)) if head is not None else heads.agg(F.min("cur").alias("cur")).where("cur is not null")
    jump = base.select("cur", F.col("step").alias("to"))
    reached = cut_lineage(start.select("cur", F.lit(0).cast("long").alias("place")))
    width = 1
    while width < 2 * n:
        ahead = (reached.join(jump.where("to is not null"), "cur").select(F.col("to").alias("cur"), (F.col("place") + width).alias("place")))
        # Where the head runs into a cycle, the first visit counts.
        reached = cut_lineage(reached.unionByName(ahead).groupBy("cur").agg(F.min("place").alias("place")))
        further = jump.select(F.col("cur").alias("to"), F.col("to").alias("then"))
        jump = cut_lineage(jump.join(further, "to", "left").select("cur", F.col("then").alias("to")))
        width *= 2
        if jump.where("to is not null").isEmpty():
            break
    # Whoever still has a page ahead never ends; what is ahead lies on a cycle.
    cycle = jump.where("to is not null").select(F.col("to").alias("cur")).distinct().withColumn("on_cycle", F.lit(True))
    marked = (base.join(reached, "cur", "left").join(cycle, "cur", "left")
              .join(heads.withColumn("is_head", F.lit(True)), "cur", "left"))
    missing = F.col("place").isNull()
    kind = (F.when(F.col("on_cycle"), "cycle").when(missing & F.col("is_head"), "head").when(missing, "unreached")
            .when(F.col("nxt").isNull(), "end").when(F.col("step").isNull(), "gap").otherwise("chain"))
    return marked.select("cur", "nxt", "place", kind.alias("kind"))
