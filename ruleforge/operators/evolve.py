"""The island evolution of rules as a plan per generation.

All draws are keyed by (seed, purpose, generation, id), so a generation can be computed again on another machine with the same result, and
in SQL. How often a rule was a parent is frozen at the start of a generation instead of being updated between two draws.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keyed import below, dense_ids, running_sums, u
from ..functions.scores import child_depth, elite_count, fitness, offspring_count
from ..sources.tables import materialize, spread
from .aggregate import islands

RULE = "id long, rule_content array<string>, generation int, parents array<long>, mutated boolean, question_type string, knowledge_point string, times_used_as_parent long, creation_method string, ancestry_depth int, island_id int"


@dataclass(frozen=True)
class Settings:
    seed: int = 7
    growth: float = 1.2
    elite: float = 0.1
    mutation: float = 0.15
    migration: float = 0.05
    interval: int = 3
    generations: int = 9


#: A weight of 1 as a whole number that 1 to 16 divide: sums of weights are exact, so they don't depend on the order of addition.
UNIT = 720_720


def slots(owed: DataFrame, group: str, count: str, stretch: int = 1000) -> DataFrame:
    """(group, slot): slots 1 to ``count`` of each group. Groups are few and their slots many, so stretches of slots are dealt over tasks before they are counted out."""
    parts = spread(owed.select(group, count, F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / stretch).cast("int"))).alias("_part")))
    first = F.col("_part").cast("long") * stretch + 1
    return parts.select(group, F.explode(F.sequence(first, F.least(first + stretch - 1, F.col(count).cast("long")))).alias("slot"))


def elites(rules: DataFrame, share: float = 0.1, island: str = "island_id", score: str = "fitness", pos: str = "id") -> DataFrame:
    """Of each island the max(1, floor(share * n)) fittest, ties by position. Ranks are taken by ranges, so no task orders an island."""
    n = rules.groupBy(island).agg(F.count("*").alias("_n"))
    ranked = dense_ids(rules.withColumn("_less", -F.col(score)), "_less", "_nth", by=(island,), ties=(pos,))
    return ranked.join(n, island).filter(F.col("_nth") < elite_count(F.col("_n"), share)).drop("_n", "_nth", "_less")


def pick_parents(tasks: DataFrame, candidates: DataFrame, group: str, slot: str, key: str, used: str, *purpose: Column | str | int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(group, slot, *keep, key): one parent for each task (group, slot), drawn with replacement among the group's candidates.

    In 4 of 10 tasks, where the group has unused candidates, any of those is as likely; in the others weights are 1 / (used + 1). Tasks meet candidates by equi-joins: on
    the number of an unused one, or on the stretch of a cumulative sum. Draws are hashed once and written, as filters and joins would each hash them anew. Several draws a task, told apart
    by columns in ``keep`` and ``purpose``, share the sorts of the candidates.
    """
    weight = F.floor(F.lit(UNIT) / (F.col(used) + 1)).cast("long")
    fresh = dense_ids(candidates.filter(F.col(used) == 0).select(group, key), key, "_at", by=(group,))
    weighed = running_sums(candidates.select(group, key, weight.alias("_w")), key, "_w", "_hi", by=(group,))
    size = candidates.groupBy(group).agg(F.count_if(F.col(used) == 0).alias("_fresh"), F.sum(weight).alias("_mass"))
    drawn = tasks.select(group, slot, *keep).join(size, group)
    drawn = drawn.withColumn("_branch", u(*purpose, "branch", F.col(group), F.col(slot))).withColumn("_draw", u(*purpose, "draw", F.col(group), F.col(slot)))
    drawn = materialize(drawn).withColumn("_even", (F.col("_branch") < 0.4) & (F.col("_fresh") > 0))
    one = drawn.filter("_even").withColumn("_at", F.floor(F.col("_draw") * F.col("_fresh"))).join(fresh, [group, "_at"])
    at = drawn.filter("not _even").withColumn("_at", F.floor(F.col("_draw") * F.col("_mass"))).withColumn("_unit", F.floor(F.col("_at") / UNIT))
    # A stretch is UNIT long at most, so it lies in one or two units: an equi-join on the unit instead of a range join.
    lo = F.col("_hi") - F.col("_w")
    stretch = weighed.select(group, key, lo.alias("_lo"), "_hi", F.explode(F.array_distinct(F.array(F.floor(lo / UNIT), F.floor((F.col("_hi") - 1) / UNIT)))).alias("_unit"))
    other = at.join(stretch, [group, "_unit"]).filter((F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))
    return one.select(group, slot, *keep, key).unionByName(other.select(group, slot, *keep, key))


def migrated(rules: DataFrame, seed: int, generation: int, rate: float = 0.05, island: str = "island_id", key: str = "id", islands: DataFrame | None = None) -> DataFrame:
    """Rules with the island they live on afterwards. m = max(1, floor(rate * size of the first island)) rules leave each island, all of one with m or
    fewer, for one other island drawn for each source among ``islands`` (by default those that hold rules), so an emptied island can be settled again. Nothing moves where there is one island only.
    """
    sizes = rules.groupBy(island).agg(F.count("*").alias("_n"))
    every = sizes.select(island) if islands is None else islands.select(island).unionByName(sizes.select(island)).distinct()
    numbered = dense_ids(every, island, "_no")
    n = numbered.count()
    least = sizes.agg(F.min_by("_n", island)).first()[0] or 0
    # Of the n - 1 others in order, the one at the place drawn.
    at = F.floor(u(seed, "target", generation, F.col(island)) * (n - 1)).cast("long")
    targets = sizes.join(numbered, island).withColumn("_goal", F.when(F.lit(n) > 1, F.when(at < F.col("_no"), at).otherwise(at + 1)).otherwise(F.col("_no")))
    targets = targets.join(numbered.select(F.col("_no").alias("_goal"), F.col(island).alias("_to")), "_goal").select(island, "_to", F.lit(max(1, math.floor(least * rate))).alias("_m"))
    drawn = dense_ids(rules.withColumn("_draw", u(seed, "migrate", generation, F.col(key))), "_draw", "_nth", by=(island,), ties=(key,))
    return drawn.join(targets, island).withColumn(island, F.when(F.col("_nth") < F.col("_m"), F.col("_to")).otherwise(F.col(island))).select(*rules.columns)


def crossed_bullets(a: Column, b: Column, share: float, *key: Column | str | int) -> Column:
    """A marker, then the distinct bullets of both parents, each kept with probability ``share``."""
    every = F.array_distinct(F.concat(a, b))
    kept = F.filter(every, lambda x, i: below(share, *key, i))
    return F.concat(F.array(F.lit("Combined rule")), kept)


def mutated_bullets(rule: Column, *key: Column | str | int) -> Column:
    """One of three kinds of change (.6, .3, .1), on one bullet (7 of 10) or as a bullet more."""
    k = u(*key, "kind")
    kind = F.when(k < 0.6, "adjusted").when(k < 0.9, "reworked").otherwise("inverted")
    at = F.floor(u(*key, "slot") * F.size(rule)).cast("int")
    edited = F.transform(rule, lambda x, i: F.when(i == at, F.concat(x, F.lit(" ("), kind, F.lit(")"))).otherwise(x))
    return F.when((u(*key, "edit") < 0.7) & (F.size(rule) > 0), edited).otherwise(F.concat(rule, F.array(F.concat(F.lit("Variation: "), kind))))


def routed(rules: DataFrame, tags: DataFrame, a: str = "question_type", b: str = "knowledge_point") -> DataFrame:
    """Rules with the island of their tag pair; unknown pairs go to island 0."""
    t = tags.select(F.col(a).alias("_a"), F.col(b).alias("_b"), F.col("island_id").alias("_island"))
    out = rules.drop("island_id").join(t, F.col(a).eqNullSafe(F.col("_a")) & F.col(b).eqNullSafe(F.col("_b")), "left")
    return out.withColumn("island_id", F.coalesce("_island", F.lit(0)).cast("int")).drop("_a", "_b", "_island")


def seeded(rules: DataFrame, pos: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rules of generation 0 on their islands, tag pairs with their island)."""
    tags = materialize(islands(rules, pos=pos))
    start = rules.select("id", "rule_content", F.lit(0).alias("generation"), F.array().cast("array<long>").alias("parents"), F.lit(False).alias("mutated"), "question_type", "knowledge_point", F.lit(0).cast("long").alias("times_used_as_parent"), F.lit("seed").alias("creation_method"), F.lit(0).alias("ancestry_depth"))
    return materialize(routed(start, tags)), tags


def next_generation(rules: DataFrame, tags: DataFrame, generation: int, settings: Settings, next_id: int) -> tuple[DataFrame, DataFrame]:
    """(population of the next generation, rules created in it).

    Migration every ``interval`` generations, elites, two parents a child, simulated crossover, mutation of a share of the children under the child's own
    id, routing by tags. An island of one rule gets a copy of it under a new id.
    """
    s, g = settings, generation
    if g % s.interval == 0:
        rules = migrated(rules, s.seed, g, s.migration, islands=tags)
    rules = materialize(rules.withColumn("fitness", fitness(F.col("times_used_as_parent"), F.col("ancestry_depth"), F.col("mutated"), u(s.seed, "fitness", g, F.col("id")))))
    best = elites(rules, s.elite).drop("fitness")
    n = rules.groupBy("island_id").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    owed = n.filter("n > 1").withColumn("k", offspring_count(F.col("n"), s.growth, s.elite)).filter("k > 0")
    tasks = slots(owed, "island_id", "k")
    sides = tasks.withColumn("side", F.explode(F.array(F.lit("p1"), F.lit("p2"))))
    picked = pick_parents(sides, rules, "island_id", "slot", "id", "times_used_as_parent", s.seed, F.col("side"), g, keep=("side",))
    drawn = picked.groupBy("island_id", "slot").agg(*(F.max(F.when(F.col("side") == p, F.col("id"))).alias(p) for p in ("p1", "p2")))
    # Children are numbered by island, then slot; the islands' ranges are cut by slot too.
    drawn = materialize(drawn.withColumn("_order", F.col("island_id").cast("double") * 2.0**31 + F.col("slot")))
    field = lambda p: rules.select(F.col("id").alias(p), F.col("rule_content").alias(f"{p}_rule"), F.col("question_type").alias(f"{p}_type"), F.col("knowledge_point").alias(f"{p}_point"), F.col("ancestry_depth").alias(f"{p}_depth"))
    both = dense_ids(drawn, "_order", "id", start=next_id).drop("_order").join(field("p1"), "p1").join(field("p2"), "p2")
    tag = lambda c: F.when(u(s.seed, c, g, F.col("id")) < 0.5, F.col(f"p1_{c}")).otherwise(F.col(f"p2_{c}"))
    child = crossed_bullets(F.col("p1_rule"), F.col("p2_rule"), 0.7, s.seed, "bullet", g, F.col("id"))
    # As columns of a step before, both are made once a row; inside the choice below each of their uses would make them anew.
    both = both.withColumn("_change", u(s.seed, "mutate", g, F.col("id")) < s.mutation).withColumn("_child", child)
    change = F.col("_change")
    born = both.select(
        "id",
        F.when(change, mutated_bullets(F.col("_child"), s.seed, g, F.col("id"))).otherwise(F.col("_child")).alias("rule_content"),
        F.lit(g).alias("generation"),
        F.array_distinct(F.array("p1", "p2")).alias("parents"),
        change.alias("mutated"),
        tag("type").alias("question_type"),
        tag("point").alias("knowledge_point"),
        F.lit(0).cast("long").alias("times_used_as_parent"),
        F.when(change, "simulated_mutation").otherwise("simulated_crossover").alias("creation_method"),
        child_depth(F.col("p1_depth"), F.col("p2_depth")).alias("ancestry_depth"),
    )
    born = materialize(routed(born, tags))
    top = born.agg(F.max("id")).first()[0]
    lone = rules.join(n.filter("n = 1").select("island_id"), "island_id", "left_semi").drop("fitness")
    copies = dense_ids(lone, "id", "_id", start=(next_id if top is None else top + 1))
    copies = copies.withColumn("parents", F.array("id")).withColumn("id", F.col("_id")).withColumn("generation", F.lit(g)).withColumn("creation_method", F.lit("replicated")).drop("_id")
    # What is written is not written again with the rest.
    created = born.unionByName(materialize(copies))
    counted = created.select(F.explode("parents").alias("id")).groupBy("id").agg(F.count("*").alias("_more"))
    kept = best.join(counted, "id", "left").withColumn("times_used_as_parent", F.col("times_used_as_parent") + F.coalesce("_more", F.lit(0))).drop("_more")
    return materialize(kept).unionByName(created), created


def evolve(rules: DataFrame, settings: Settings = Settings(), on_generation=None, done: tuple[int, DataFrame, DataFrame] | None = None) -> DataFrame:
    """All rules of all generations, seeds first. ``on_generation(generation, population, created)`` may save each generation.

    ``done`` (generation, population, all rules so far) goes on from a saved generation, with the same result as a run without a break.
    """
    population, tags = seeded(rules)
    first, population, every = (0, population, population) if done is None else done
    for g in range(first + 1, settings.generations + 1):
        next_id = every.agg(F.max("id")).first()[0]
        if next_id is None:
            break
        population, created = next_generation(population, tags, g, settings, next_id + 1)
        every = every.unionByName(created)
        if on_generation:
            on_generation(g, population, created)
    return every
