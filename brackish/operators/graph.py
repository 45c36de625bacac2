"""Graph computations as rounds of joins with few rounds and no hub in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brackish.session import cut_rounds


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node each node is connected to.

    Every round hooks nodes and the roots they point to onto the smallest
    neighbouring grandparent and halves the chains, so the rounds grow with the
    logarithm of the diameter.  A hub is only ever a key of a minimum, which
    combines map-side, or of a join whose other side has one row per node.
    """
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    both = cut_rounds(one.union(one.select("v", "u")).distinct())
    f = cut_rounds(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")))
    while True:
        parents = f.select(F.col("u").alias("p"), F.col("p").alias("g"))
        grand = f.join(parents, "p")
        seen = grand.select(F.col("u").alias("v"), "g")
        least = both.join(seen, "v").groupBy("u").agg(F.min("g").alias("m"))
        known = grand.join(least, "u")
        offers = known.select(
            F.inline(F.array(F.struct(F.col("u").alias("u"), F.least("m", "g").alias("p")), F.struct(F.col("p").alias("u"), F.col("m").alias("p"))))
        ).withColumn("old", F.lit(None))
        kept = f.select("u", "p", F.col("p").alias("old"))
        new = cut_rounds(kept.union(offers).groupBy("u").agg(F.min("p").alias("p"), F.max("old").alias("old")))
        settled = new.where("p <> old").isEmpty()
        f = new.drop("old")
        if settled:
            return f.select(F.col("u").alias("node"), F.col("p").alias("component"))


def hop_distance(
    nodes: DataFrame, edges: DataFrame, seeds: DataFrame, node: str, a: str, b: str, unreachable: int = 2147483647,
) -> DataFrame:
    """Breadth-first hops from the nearest seed; only the newest ring is joined each round."""
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = cut_rounds(one.union(one.select("v", "u")).distinct())
    ring = cut_rounds(seeds.select(F.col(node).alias("u")).distinct().withColumn("d", F.lit(0)))
    seen, before = ring, ring
    hop = 0
    while True:
        hop += 1
        # What a ring can reach is older by at most one ring: no growing table is searched.
        reached = ring.join(both, "u").select(F.col("v").alias("u")).distinct()
        known = ring.select("u").union(before.select("u"))
        before, ring = ring, cut_rounds(reached.join(known, "u", "left_anti").withColumn("d", F.lit(hop)))
        if ring.isEmpty():
            break
        seen = seen.union(ring)
        if hop % 64 == 0:
            seen = cut_rounds(seen)
    return nodes.select(node).join(seen.withColumnRenamed("u", node), node, "left").select(
        node, F.coalesce("d", F.lit(unreachable)).alias("distance")
    )


def path_order(arcs: DataFrame, arc: str, down: str) -> DataFrame:
    """Longest upstream path per arc: headwaters 1, others 1 + the most of those above.

    ``down`` is the next arc, null at an outlet.  After round k an arc knows its
    longest path of up to 2^k hops and the arc 2^k hops below, so the rounds are
    the logarithm of the depth.  Arcs on a cycle get -1.
    """
    state = cut_rounds(arcs.select(F.col(arc).alias("u"), F.col(down).alias("jump"), F.lit(0).cast("long").alias("above")))
    most = max(state.count(), 1)
    hops = 1
    while True:
        offers = state.where("jump is not null").select(
            F.col("jump").alias("u"), (F.col("above") + hops).alias("offer")
        ).groupBy("u").agg(F.max("offer").alias("offer"))
        far = state.select(F.col("u").alias("jump"), F.col("jump").alias("next"))
        state = cut_rounds(
            state.join(offers, "u", "left").join(far, "jump", "left").select(
                "u", F.col("next").alias("jump"), F.greatest("above", "offer").alias("above")
            )
        )
        hops *= 2
        if hops > most or state.where("jump is not null").isEmpty():
            break
    cyclic = state.where("jump is not null").select(F.col("jump").alias("u")).distinct().withColumn("_cycle", F.lit(True))
    return state.join(cyclic, "u", "left").select(
        F.col("u").alias(arc),
        F.when(F.col("_cycle"), F.lit(-1)).otherwise(F.col("above") + 1).cast("long").alias("path_order"),
    )


def ring_order(arrows: DataFrame, a: str, b: str, turns: DataFrame | None = None) -> DataFrame:
    """(ring, toward, position, node) of closed chains given as arrows a -> b.

    A ring starts at its least node, ``ring``; ``toward`` is the node after it, which tells rings apart that
    meet there.  ``turns`` (before, node, after) says how chains go on at nodes that are on
    several; elsewhere a node has one arrow out.  Pointer doubling runs over arrows, not
    nodes, twice: for the least arrow of each ring, then for the number of steps from it.
    """
    pair = lambda p, q: F.struct(F.col(p).alias("p"), F.col(q).alias("q"))
    one = arrows.select(pair(a, b).alias("u"), F.col(b).alias("end")).distinct()
    out = one.select(F.col("u.p").alias("end"), F.col("u").alias("next"))
    if turns is None:
        linked = one.join(out, "end").select("u", "next")
    else:
        told = turns.select(pair("before", "node").alias("u"), pair("node", "after").alias("next"))
        linked = one.join(told, "u", "left_anti").join(out, "end").select("u", "next").unionByName(told)
    linked = cut_rounds(linked)
    state = cut_rounds(linked.select("u", F.col("next").alias("jump"), F.least("u", "next").alias("low")))
    most, hops = max(state.count(), 1), 1
    while hops <= most:
        far = state.select(F.col("u").alias("jump"), F.col("jump").alias("next"), F.col("low").alias("low2"))
        state = cut_rounds(state.join(far, "jump").select("u", F.col("next").alias("jump"), F.least("low", "low2").alias("low")))
        hops *= 2
    ring = state.select("u", F.col("low").alias("ring"))
    back = linked.select(F.col("next").alias("u"), F.col("u").alias("prev")).join(ring, "u")
    rank = cut_rounds(
        back.select("u", "ring", F.when(F.col("u") != F.col("ring"), F.col("prev")).alias("jump"),
                    F.when(F.col("u") != F.col("ring"), 1).otherwise(0).cast("long").alias("steps"))
    )
    while not rank.where("jump is not null").isEmpty():
        far = rank.select(F.col("u").alias("jump"), F.col("jump").alias("next"), F.col("steps").alias("more"))
        rank = cut_rounds(
            rank.join(far, "jump", "left").select(
                "u", "ring", F.col("next").alias("jump"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
            )
        )
    return rank.select(F.col("ring.p").alias("ring"), F.col("ring.q").alias("toward"), F.col("steps").alias("position"), F.col("u.p").alias("node"))
