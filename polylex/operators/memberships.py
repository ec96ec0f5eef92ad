"""Neighbors without their pairs: which groups a concept is in, exact counts, pairs for chosen concepts only.

Four of the six neighbor relations join all concepts that have something in common: a class, a
role, a structure block, a hydride. A role of 100,000 concepts has 10^10 such pairs, but only
100,000 memberships. What stage 3 asks can be answered from those: how many distinct neighbors a
concept has in the corpus, and which they are for the few concepts of the sample.

Counts are exact. Concepts in the same groups share one count. The members of groups of more
than ``HUB`` are united as bitmaps, once for each set of such groups; members of smaller groups
are listed, less those that one of the large groups has too. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import RELATIONS
from ..shared import settle
from .ontology import conjugate_pair, tautomers

#: A group of more members is united as a bitmap.
HUB = 256
#: Bits of a bitmap, fixed by Spark; concepts are dealt into buckets of about half as many.
BITS = 32768


def memberships(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(chebi_id, relation, group), each once."""
    of = lambda rel, name: edges.where(F.col("rel") == rel).select(F.col("src").alias("chebi_id"), F.lit(name).alias("relation"), F.col("dst").alias("group"))
    blocks = nodes.where(F.length("inchikey") >= 14).select("chebi_id", F.lit(RELATIONS[4]).alias("relation"), F.substring("inchikey", 1, 14).alias("group"))
    return of("is_a", RELATIONS[0]).unionByName(of("has_role", RELATIONS[1])).unionByName(blocks).unionByName(of("has_parent_hydride", RELATIONS[5])).distinct()


def links(edges: DataFrame) -> DataFrame:
    """(chebi_id, neighbor, relation) of the two relations that link one concept to another."""
    return conjugate_pair(edges).unionByName(tautomers(edges))


def neighbors_of(member: DataFrame, direct: DataFrame, of: DataFrame) -> DataFrame:
    """(chebi_id, neighbor, relation, prio) of the concepts in of (chebi_id) alone."""
    mine = member.join(of.select("chebi_id").distinct(), "chebi_id", "left_semi")
    pairs = mine.join(member.withColumnRenamed("chebi_id", "neighbor"), ["relation", "group"]).where("chebi_id <> neighbor")
    out = pairs.select("chebi_id", "neighbor", "relation").distinct().unionByName(direct.join(of.select("chebi_id").distinct(), "chebi_id", "left_semi"))
    return out.withColumn("prio", F.array_position(F.array(*(F.lit(r) for r in RELATIONS)), F.col("relation")).cast("int"))


def _placed(ids: DataFrame) -> DataFrame:
    """ids (chebi_id) with bucket and bit: a place of its own for each."""
    buckets = 1 + ids.count() // (BITS // 2)
    x = ids.withColumn("b", F.pmod(F.xxhash64("chebi_id"), F.lit(buckets)))
    k = F.row_number().over(Window.partitionBy("b").orderBy("chebi_id")) - 1
    return x.withColumn("k", k).select("chebi_id", (F.col("b") + F.floor(F.col("k") / BITS) * buckets).alias("bucket"), (F.col("k") % BITS).cast("long").alias("bit"))


def neighbor_counts(member: DataFrame, direct: DataFrame, present: DataFrame, hub: int = HUB) -> DataFrame:
    """(chebi_id, n): how many distinct neighbors of any relation each concept of present (chebi_id) has in present; those with none are left out."""
    held = lambda df, name: settle(df, f"neighbor-counts-{name}")[0]  # what several steps read is written, so that plans stay small
    ids = held(present.select("chebi_id").distinct(), "ids")
    g = member.join(ids, "chebi_id", "left_semi").select("chebi_id", F.concat_ws("|", "relation", "group").alias("g"))
    sizes = g.groupBy("g").agg(F.count("*").alias("size"))
    g = held(g.join(sizes, "g").withColumn("large", F.col("size") > hub).select("chebi_id", "g", "large"), "groups")
    sets = lambda big: F.array_sort(F.collect_set(F.when(F.col("large") == big, F.col("g"))))
    own = held(g.groupBy("chebi_id").agg(sets(True).alias("hubs"), sets(False).alias("few")), "own")
    maps = g.where("large").join(_placed(ids), "chebi_id").groupBy("g", "bucket").agg(F.bitmap_construct_agg("bit").alias("m"))
    hubs = own.where("size(hubs) > 0").select("hubs").distinct().withColumn("g", F.explode("hubs"))
    united = hubs.join(maps, "g").groupBy("hubs", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("m")).alias("n")).groupBy("hubs").agg(F.sum("n").alias("n_hubs"))
    kinds = held(own.where("size(few) > 0").select("hubs", "few").distinct().withColumn("kind", F.monotonically_increasing_id()), "kinds")
    listed = held(kinds.select("kind", F.explode("few").alias("g")).join(g.where("not large").select("g", F.col("chebi_id").alias("m")), "g").select("kind", "m").distinct(), "listed")
    inside = g.where("large").select(F.col("chebi_id").alias("m"), "g")
    twice = listed.join(kinds.select("kind", F.explode("hubs").alias("g")), "kind").join(inside, ["m", "g"], "left_semi").select("kind", "m").distinct()
    more = held(listed.join(twice, ["kind", "m"], "left_anti").groupBy("kind").agg(F.count("*").alias("n_few")), "few")
    counted = own.join(held(united, "hubs"), "hubs", "left").join(kinds.join(more, "kind").drop("kind"), ["hubs", "few"], "left")
    in_groups = counted.select("chebi_id", (F.coalesce("n_hubs", F.lit(0)) + F.coalesce("n_few", F.lit(0)) - 1).alias("n"))  # without itself
    pair = held(direct.select("chebi_id", "neighbor").distinct().join(ids, "chebi_id", "left_semi").join(ids.withColumnRenamed("chebi_id", "neighbor"), "neighbor", "left_semi"), "pairs")
    both = pair.join(g.select("chebi_id", "g"), "chebi_id").join(g.select(F.col("chebi_id").alias("neighbor"), "g"), ["neighbor", "g"], "left_semi")
    alone = pair.join(both.select("chebi_id", "neighbor").distinct(), ["chebi_id", "neighbor"], "left_anti").groupBy("chebi_id").agg(F.count("*").alias("n"))
    return in_groups.unionByName(alone).groupBy("chebi_id").agg(F.sum("n").cast("long").alias("n")).where("n > 0")


def link_totals(member: DataFrame, direct: DataFrame) -> DataFrame:
    """(chebi_id, n_links): the neighbors of each concept, counted once for each relation; those with none are left out."""
    tag = lambda c: F.concat_ws("|", "relation", c).alias(c)  # concepts of each relation for themselves
    m = member.where("chebi_id is not null and group is not null").select(tag("chebi_id"), "relation", "group")
    d = direct.select(tag("chebi_id"), tag("neighbor"), "relation")
    present = m.select("chebi_id").unionByName(d.select("chebi_id")).unionByName(d.select(F.col("neighbor").alias("chebi_id")))
    return neighbor_counts(m, d, present).groupBy(F.expr("substr(chebi_id, instr(chebi_id, '|') + 1)").alias("chebi_id")).agg(F.sum("n").alias("n_links"))
