"""Concept instances: qualifying concepts, a balanced sample, gold documents, hard negatives.

``linked`` is a table of documents with mentions, ``concepts`` the graph artifact. All choices
follow functions.text.md5_key, so a run with the same seed gives the same instances.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import coarse_type, md5_key
from ..schema import LANGS, Config
from ..shared import settle
from ..shipping import ship
from .ontology import neighbors_of_slice


def corpus_index(linked: DataFrame) -> DataFrame:
    """(chebi_id, id, language): which documents mention a concept, each once."""
    return linked.select(F.explode(F.array_distinct("mentions.chebi_id")).alias("chebi_id"), "id", "language")


def concept_languages(index: DataFrame) -> DataFrame:
    """(chebi_id, n_langs)."""
    return index.groupBy("chebi_id").agg(F.count_distinct("language").alias("mention_langs"))


def corpus_frequency(linked: DataFrame) -> DataFrame:
    """(chebi_id, n): mentions in the corpus."""
    return linked.select(F.explode("mentions.chebi_id").alias("chebi_id")).groupBy("chebi_id").agg(F.count("*").alias("freq"))


def qualifying_concepts(concepts: DataFrame, index: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """In two languages of the corpus, aliases in three, a neighbor in the corpus, two or three stars.

    counts (chebi_id, n) are the neighbors in the corpus (memberships.neighbor_counts); without them, the graph's lists are counted.
    """
    langs = concept_languages(index)
    named = sum((F.when(F.size(F.col("aliases_combined")[x]) > 0, 1).otherwise(0) for x in LANGS), F.lit(0))
    x = concepts.where("chebi_star in (2, 3)").withColumn("alias_lang_count", named.cast("int")).where("alias_lang_count >= 3")
    x = x.join(langs.where("mention_langs >= 2"), "chebi_id")
    if counts is None:
        near = neighbors_of_slice(concepts).select("chebi_id", "neighbor").distinct().join(langs.select(F.col("chebi_id").alias("neighbor")), "neighbor", "left_semi")
        counts = near.groupBy("chebi_id").agg(F.count("*").alias("n"))
    near = counts.withColumnRenamed("n", "neighbor_count_in_corpus")
    return x.join(near, "chebi_id").select("chebi_id", F.col("chebi_star").alias("star"), "alias_lang_count", F.col("mention_langs").alias("mention_lang_count"), "neighbor_count_in_corpus", coarse_type(F.col("roles"), F.col("formula")).alias("coarse"))


def balanced_sample(candidates: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Three stars first; from each stratum in turn, up to the target. Tasks give the first of each stratum only, before any exchange."""
    nth = F.row_number().over(Window.partitionBy("star", "coarse", "alias_lang_count").orderBy(md5_key(cfg.seed, "sample", F.col("chebi_id")), "chebi_id"))
    x = candidates.withColumn("turn", nth).where(F.col("turn") <= cfg.bench1_target)
    return x.orderBy(F.desc("star"), "turn", md5_key(cfg.seed, "stratum", F.col("coarse"), F.col("alias_lang_count")), "chebi_id").limit(cfg.bench1_target).drop("turn")


def gold_documents(index: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(chebi_id, gold_language, gold_id): a language of the concept, then a document in it, each by its hash."""
    lang = index.select("chebi_id", "language").distinct().groupBy("chebi_id").agg(F.min_by("language", md5_key(cfg.seed, "gold_lang", F.col("chebi_id"), F.col("language"))).alias("language"))
    own = index.join(lang, ["chebi_id", "language"])
    best = F.struct(md5_key(cfg.seed, "gold_doc", F.col("chebi_id"), F.col("id")), "id")
    return own.groupBy("chebi_id", F.col("language").alias("gold_language")).agg(F.min_by("id", best).alias("gold_id"))


def gold_all(index: DataFrame) -> DataFrame:
    """Every document of every concept."""
    return index.select("chebi_id", "language", "id")


def negative_pool(gold: DataFrame, near: DataFrame, index: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(chebi_id, neighbor, relation, id, language, turn): documents of neighbors, in another language, without the concept.

    turn is a document's place in the order of its concept, neighbor and language.
    """
    first = near.groupBy("chebi_id", "neighbor").agg(F.min_by("relation", "prio").alias("relation"))
    docs = index.withColumnRenamed("chebi_id", "neighbor")
    x = gold.select("chebi_id", "gold_language").join(first, "chebi_id").where("chebi_id <> neighbor").join(docs, "neighbor").where("language <> gold_language")
    x = x.join(index.select("chebi_id", "id"), ["chebi_id", "id"], "left_anti")
    turn = F.row_number().over(Window.partitionBy("chebi_id", "neighbor", "language").orderBy(md5_key(cfg.seed, "neg", F.col("chebi_id"), F.col("neighbor"), F.col("id")), "id"))
    return x.withColumn("turn", turn).select("chebi_id", "neighbor", "relation", "id", "language", "turn")


def choose_negatives(pool: list[tuple[str, str, str]], most: int) -> list[int]:
    """Which of (neighbor, language, id), in order: two points for a new neighbor, one for a new language, each document once.

    After every choice the queue is put in the order of points, and what has equal points keeps
    the order that it had by then, not that of the pool.
    """
    queue, chosen = list(range(len(pool))), []
    seen_n: set[str] = set()
    seen_l: set[str] = set()
    while queue and len(chosen) < most:
        queue.sort(key=lambda k: -2 * (pool[k][0] not in seen_n) - (pool[k][1] not in seen_l))
        k = queue[0]
        chosen.append(k)
        seen_n.add(pool[k][0])
        seen_l.add(pool[k][1])
        queue = [x for x in queue if pool[x][2] != pool[k][2]]
    return chosen


class Narrowing:
    """Tells of (neighbor, id) pairs of one concept and language, in their order, which the greedy choice can still reach.

    Of two documents in one language the earlier stays ahead unless its neighbor has been used or its id taken.
    The choices before the last are ``most`` - 1, so a pair is out of reach behind ``most`` of its own neighbor,
    behind ``most`` of its own id, and behind 2 * ``most`` - 1 that share neither neighbor nor id with one another,
    as a choice ends the lead of two of those at most. That holds for any part of the pairs too.
    The state has at most 2 * ``most`` - 1 neighbors and ids; at most 2 * ``most`` times as many pairs pass.
    """

    def __init__(self, most: int):
        self.most, self.last = most, None
        self.neighbors: dict[str, int] = {}
        self.ids: dict[str, int] = {}

    def passes(self, neighbor: str, doc: str) -> bool:
        if len(self.neighbors) == 2 * self.most - 1 or (neighbor, doc) == self.last:
            return False
        n, d = self.neighbors.get(neighbor), self.ids.get(doc)
        if n is None and d is None:
            self.neighbors[neighbor] = self.ids[doc] = 1
        elif max(n or 0, d or 0) >= self.most:
            return False
        else:
            if n is not None:
                self.neighbors[neighbor] = n + 1
            if d is not None:
                self.ids[doc] = d + 1
        self.last = (neighbor, doc)
        return True


def narrowed(pool: DataFrame, most: int) -> DataFrame:
    """The rows of a pool, with their order k, that Narrowing passes within each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, Narrowing(most)
        for b in batches:
            keep = []
            for row, (concept, language, neighbor, doc) in enumerate(zip(*(b.column(c).to_pylist() for c in ("chebi_id", "language", "neighbor", "id")), strict=True)):
                if (concept, language) != at:
                    at, state = (concept, language), Narrowing(most)
                if state.passes(neighbor, doc):
                    keep.append(row)
            yield b.take(pa.array(keep, pa.int32()))

    return pool.sortWithinPartitions("chebi_id", "language", "k", "neighbor", "id").mapInArrow(run, pool.schema)


def hard_negatives(pool: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(chebi_id, rank, neighbor, relation, id, language): the greedy choice for each concept.

    Of each concept, neighbor and language only twice as many documents as can be chosen are
    looked at, which loses nothing: such a class gives its documents in order, at most
    ``max_negatives`` of them, and loses at most as many to choices from other classes. The rest is
    narrowed where it lies and once more by concept and language, so a concept of any number of
    neighbors comes to its choice as some hundreds of rows for each language.
    """
    return _chosen(pool.where(F.col("turn") <= 2 * cfg.max_negatives), cfg)


def _chosen(pool: DataFrame, cfg: Config) -> DataFrame:
    """The greedy choice from the rows of a pool that can be reached, by and by narrowed."""
    ship(pool.sparkSession)
    most = cfg.max_negatives
    keyed = pool.withColumn("k", _negative_key(cfg, F.col("id")))  # the order within classes too
    keyed = narrowed(narrowed(keyed, most).repartition("chebi_id", "language"), most)

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values(["k", "neighbor", "id"]).reset_index(drop=True)
        rows = choose_negatives(list(zip(g["neighbor"], g["language"], g["id"], strict=True)), most)
        out = g.loc[rows, ["chebi_id", "neighbor", "relation", "id", "language"]].reset_index(drop=True)
        out.insert(1, "rank", range(1, len(out) + 1))
        return out.astype({"rank": "int32"})

    return keyed.groupBy("chebi_id").applyInPandas(pick, "chebi_id string, rank int, neighbor string, relation string, id string, language string")


def _negative_key(cfg: Config, doc: F.Column) -> F.Column:
    return md5_key(cfg.seed, "neg", F.col("chebi_id"), F.col("neighbor"), doc)


def reachable(gold: DataFrame, near: DataFrame, index: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(chebi_id, neighbor, relation, id, language): of negative_pool, what the greedy choice can reach, without exchanging the pool.

    A neighbor's documents are a list for each language, which meets its pairs where it lies; only the first few by
    hash leave it. Where a concept has many neighbors, the least of each tell first behind what nothing is reached
    (see Narrowing). The concept's own documents are taken out of the few; a class that has too few left is formed whole.
    """
    most, few, many = cfg.max_negatives, cfg.max_negatives + 2, 2 * cfg.max_negatives - 1
    first = near.where("chebi_id <> neighbor").groupBy("chebi_id", "neighbor").agg(F.min_by("relation", "prio").alias("relation"))
    pairs = settle(gold.select("chebi_id", "gold_language").join(first, "chebi_id"), "negative-pairs")[0]
    docs = settle(index.groupBy(F.col("chebi_id").alias("neighbor"), "language").agg(F.collect_set("id").alias("ids")), "negative-docs")[0]
    own = index.select("chebi_id", "id")
    keyed = F.transform("ids", lambda x: F.struct(_negative_key(cfg, x).alias("k"), x.alias("id")))

    rich = pairs.groupBy("chebi_id").agg(F.count("*").alias("n")).where(F.col("n") >= many).select("chebi_id")
    least = pairs.join(rich, "chebi_id", "left_semi").join(docs, "neighbor").where("language <> gold_language").select("chebi_id", "language", "neighbor", F.array_min(keyed).alias("x"))
    least = least.select("chebi_id", "language", "neighbor", "x.k", "x.id").join(own, ["chebi_id", "id"], "left_anti")
    order = Window.partitionBy("chebi_id", "language", "id").orderBy("k", "neighbor")  # one for each document: these share neither neighbor nor id
    nth = Window.partitionBy("chebi_id", "language").orderBy("k", "neighbor", "id")
    alone = least.withColumn("n", F.row_number().over(order)).where("n = 1").withColumn("n", F.row_number().over(nth))
    end = settle(alone.where(F.col("n") == many).select("chebi_id", "language", F.col("k").alias("end")), "negative-ends")[0]

    x = pairs.join(docs, "neighbor").where("language <> gold_language").join(end, ["chebi_id", "language"], "left")
    x = x.withColumn("x", F.filter(keyed, lambda d: F.col("end").isNull() | (d["k"] <= F.col("end"))))
    x = x.select("chebi_id", "neighbor", "relation", "language", (F.size("x") > few).alias("more"), F.explode(F.slice(F.sort_array("x"), 1, few)).alias("d"))
    x = settle(x.select("chebi_id", "neighbor", "relation", "language", "more", "d.id"), "negative-few")[0]
    shared = settle(x.join(own, ["chebi_id", "id"], "left_semi"), "negative-shared")[0]
    x = x.join(shared.select("chebi_id", "neighbor", "id"), ["chebi_id", "neighbor", "id"], "left_anti")
    classes = ["chebi_id", "neighbor", "relation", "language"]
    short = shared.where("more").groupBy(*classes).agg(F.count("*").alias("n")).where(F.col("n") > few - most).select(*classes)
    whole = short.join(docs, ["neighbor", "language"]).select(*classes, F.explode("ids").alias("id")).join(own, ["chebi_id", "id"], "left_anti")
    return x.join(short, classes, "left_anti").select(*classes, "id").unionByName(whole.select(*classes, "id"))


def hard_negatives_of(gold: DataFrame, near: DataFrame, index: DataFrame, cfg: Config = Config()) -> DataFrame:
    """hard_negatives of negative_pool of the same tables, without the pool."""
    return _chosen(reachable(gold, near, index, cfg), cfg)


def neighbor_concepts(negatives: DataFrame, concepts: DataFrame) -> DataFrame:
    """(chebi_id, neighbor, name, relation, aliases): the neighbors used that the graph has."""
    used = negatives.groupBy("chebi_id", "neighbor").agg(F.min("relation").alias("relation"))
    return used.join(concepts.select(F.col("chebi_id").alias("neighbor"), "chebi_name_en", "aliases_combined"), "neighbor")


def payload(docs: DataFrame, concept: str = "chebi_id") -> F.Column:
    """A document as nested record, with the mentions of one concept."""
    own = F.filter("mentions", lambda m: m["chebi_id"] == F.col(concept))
    return F.struct("id", "publication_number", "language", "text", own.alias("mentions"))


def instances(sample: DataFrame, concepts: DataFrame, linked: DataFrame, cfg: Config = Config(), near: DataFrame | None = None) -> DataFrame:
    """The nested records; concepts without negatives are left out. Texts are joined last.

    near (chebi_id, neighbor, relation, prio) has the sample's neighbors (memberships.neighbors_of); without it, the graph's lists are used.
    """
    index = corpus_index(linked)
    chosen = F.broadcast(sample.select("chebi_id"))  # bench1_target rows at most
    gold = gold_documents(index.join(chosen, "chebi_id"), cfg)
    negs = hard_negatives(negative_pool(gold, (neighbors_of_slice(concepts) if near is None else near).join(chosen, "chebi_id"), index, cfg), cfg)
    gold_doc = gold.join(linked.withColumnRenamed("id", "gold_id"), "gold_id").withColumnRenamed("gold_id", "id").select("chebi_id", "gold_language", payload(linked).alias("gold_document"))
    texts = negs.select("chebi_id", "rank", "neighbor", "relation", "id").join(linked, "id")
    own = F.filter("mentions", lambda m: m["chebi_id"] == F.col("neighbor"))
    record = F.struct("rank", "id", "publication_number", "language", "text", own.alias("mentions"), F.col("neighbor").alias("neighbor_chebi_id"), "relation")
    lists = texts.groupBy("chebi_id").agg(F.transform(F.array_sort(F.collect_list(record)), lambda r: r.dropFields("rank")).alias("hard_negative_documents"))
    beside = neighbor_concepts(negs, concepts).groupBy("chebi_id").agg(F.array_sort(F.collect_list(F.struct(F.col("neighbor").alias("chebi_id"), "chebi_name_en", "aliases_combined", "relation"))).alias("neighbor_concepts"))
    head = concepts.join(chosen, "chebi_id").select("chebi_id", "inchikey", F.col("aliases_combined").alias("multilingual_aliases"))
    return head.join(gold_doc, "chebi_id").join(lists, "chebi_id").join(beside, "chebi_id", "left").withColumn("neighbor_concepts", F.coalesce("neighbor_concepts", F.array())).orderBy("chebi_id")


def summary(found: DataFrame, candidates: DataFrame, sample: DataFrame, cfg: Config = Config()) -> list[DataFrame]:
    """One-row tables: counts, relations, gold and negative languages."""
    negs = found.select(F.explode("hard_negative_documents").alias("n")).select("n.relation", "n.language")
    tally = lambda d, c, name: d.groupBy(F.col(c).alias("k")).count().agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "count")))).alias(name))
    n = found.agg(F.count("*").alias("instances_written"))
    q = candidates.agg(F.count("*").alias("qualifying_concepts"))
    s = sample.agg(F.count("*").alias("sampled"), F.lit(cfg.bench1_target).alias("sample_target"), F.lit(cfg.seed).alias("seed"))
    return [n, q, s, tally(negs, "relation", "relation_counts"), tally(found, "gold_language", "gold_doc_languages"), tally(negs, "language", "negative_doc_languages")]

