"""The four stages as file-to-file plans, with the artifacts' names."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nfc
from ..functions import text as tx
from ..operators import crosswalk, instances, linking, memberships, nouns, ontology, providers, sentences, variants
from ..schema import TEXT_FIELDS, Config
from ..sources import readers, sinks


@dataclass(frozen=True)
class Paths:
    """Where inputs and artifacts are; any file system that Spark knows."""

    corpus: str
    raw: str
    out: str
    titles: str | None = None  # a ready crosswalk
    lexicon: str | None = None

    @property
    def titles_cache(self) -> str:
        return f"{self.out}/titles_cache.jsonl"

    @property
    def concepts(self) -> str:
        return f"{self.out}/chebi_concepts.parquet"

    @property
    def memberships(self) -> str:
        return f"{self.out}/memberships.parquet"

    @property
    def links(self) -> str:
        return f"{self.out}/links.parquet"

    @property
    def linked(self) -> str:
        return f"{self.out}/documents_linked.parquet"

    @property
    def instances(self) -> str:
        return f"{self.out}/idea1/instances.jsonl"

    @property
    def variants(self) -> str:
        return f"{self.out}/idea2/instances.jsonl"


def documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Corpus rows with composed fields, and their joined texts."""
    rows = readers.read_corpus_csv(spark, path).withColumns({f: nfc(f) for f in TEXT_FIELDS})
    return rows, rows.select("id", "publication_number", "language", tx.corpus_text().alias("text"))


def _saved(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    sinks.write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _ids(by_row: DataFrame) -> DataFrame:
    return by_row.select(F.explode("ids").alias("chebi_id")).distinct()


def build_graph(spark: SparkSession, p: Paths, cfg: Config = Config(), lookup: crosswalk.Lookup | None = None) -> None:
    """Stage 1: the concepts that the corpus mentions, with aliases and neighbors.

    With titles, from a table or a lookup, titles of the concepts first found are aliases too,
    and the concepts found with them are those of the graph. For that, only documents in which a
    key stands that is new or names other concepts now are linked again.
    """
    tsv = lambda n: readers.read_tsv(spark, f"{p.raw}/{n}.tsv.gz")
    terms = readers.read_obo(spark, f"{p.raw}/chebi.obo")
    nodes = ontology.merge_nodes(terms, ontology.parse_compounds(tsv("compounds")), ontology.parse_structures(tsv("structures")), ontology.parse_chemical_data(tsv("chemical_data")))
    edges = ontology.is_a_edges(terms).unionByName(ontology.parse_relations(tsv("relation"), tsv("relation_type")))
    aliases = ontology.parse_names(tsv("names"))
    docs = _saved(spark, documents(spark, p.corpus)[1].withColumn("row", F.monotonically_increasing_id()), f"{p.out}/documents.parquet")

    def titled(ids: DataFrame) -> DataFrame:
        return crosswalk.crosswalk(ids, lookup, p.titles_cache) if lookup else readers.read_titles(spark, p.titles).join(ids, "chebi_id", "left_semi")

    dictionary = _saved(spark, linking.invert(aliases, cfg), f"{p.out}/dictionary.parquet")
    known = _saved(spark, linking.mentioned_by_row(linking.link_exact(docs, dictionary, cfg)), f"{p.out}/mentioned.parquet")
    mentioned, titles, combined = _ids(known), None, aliases
    if p.titles or lookup:
        wider = _saved(spark, linking.invert(ontology.aliases_combined(aliases, titled(mentioned)), cfg), f"{p.out}/dictionary_again.parquet")
        again = _saved(spark, linking.mentioned_again(docs, known, dictionary, wider, cfg), f"{p.out}/mentioned_again.parquet")
        titles = titled(mentioned.unionByName(_ids(again)).distinct())  # a lookup is asked for the new ones only
        mentioned, combined = _ids(again), ontology.aliases_combined(aliases, titles)
    sinks.write_parquet(ontology.concept_slice(nodes, edges, aliases, combined, mentioned, titles, not cfg.memberships).orderBy("chebi_id"), p.concepts)
    ragged = [readers.ragged_rows(spark, f"{p.raw}/{n}.tsv.gz") for n in ("compounds", "names", "structures", "chemical_data", "relation", "relation_type")]
    reduce(DataFrame.unionByName, ragged).coalesce(1).write.mode("overwrite").json(f"{p.out}/ragged_rows.json")
    if cfg.memberships:
        sinks.write_parquet(memberships.memberships(nodes, edges), p.memberships)
        sinks.write_parquet(memberships.links(edges), p.links)


def link_corpus(spark: SparkSession, p: Paths, cfg: Config = Config()) -> None:
    """Stage 2: mentions in every document."""
    aliases = ontology.aliases_of_slice(readers.read_concepts(spark, p.concepts))
    sinks.write_parquet(linking.linked_documents(linking.link(documents(spark, p.corpus)[1], aliases, cfg)), p.linked)


def build_instances(spark: SparkSession, p: Paths, cfg: Config = Config()) -> int:
    """Stage 3: concept instances with gold documents and hard negatives."""
    concepts, linked = readers.read_concepts(spark, p.concepts), readers.read_linked(spark, p.linked)
    index, counts, near = instances.corpus_index(linked), None, None
    if cfg.memberships:
        member, direct = spark.read.parquet(p.memberships), spark.read.parquet(p.links)
        counts = memberships.neighbor_counts(member, direct, index.select("chebi_id"))
    candidates = instances.qualifying_concepts(concepts, index, counts)
    sample = instances.balanced_sample(candidates, cfg)
    if cfg.memberships:
        near = memberships.neighbors_of(member, direct, sample)
    found = instances.instances(sample, concepts, linked, cfg, near)
    n = sinks.write_jsonl(found, p.instances)
    sinks.write_summary(instances.summary(readers.read_jsonl(spark, p.instances, found.schema), candidates, sample, cfg), f"{p.out}/idea1/run_summary.json")
    return n


@dataclass(frozen=True)
class Model:
    """A provider of terms and checks, and where its replies are kept."""

    provider: providers.Provider
    name: str
    cache: str

    def hooks(self) -> dict[str, variants.Hook]:
        # a folder for each: one plan must not read one path as it was at two times
        bound = lambda f, kind: lambda cells: f(cells, self.provider, f"{self.cache}/{kind}", self.name)
        return {"provide": bound(providers.provide_by_model, "terms"), "judge": bound(providers.judge_by_model, "judged"), "back": bound(providers.back_by_model, "back")}


def build_variants(spark: SparkSession, p: Paths, cfg: Config = Config(), limit: int | None = None, model: Model | None = None) -> int:
    """Stage 4: document variants; with a model, its terms and its checks."""
    concepts, linked = readers.read_concepts(spark, p.concepts), readers.read_linked(spark, p.linked)
    corpus = documents(spark, p.corpus)[0]
    rows = variants.with_fields(variants.sample_rows(linked, variants.available_languages(corpus), cfg, limit), corpus)
    lexicon = "lang string, word string, swap_lang string, term string"
    words = readers.read_jsonl(spark, p.lexicon, lexicon) if p.lexicon else spark.createDataFrame([], lexicon)
    checked = variants.checked_cells(rows, linked, instances.corpus_frequency(linked), ontology.aliases_of_slice(concepts), words, cfg, **(model.hooks() if model else {}), abbreviations=sentences.abbreviations(linked), nouns=nouns.noun_words(linked))
    n = sinks.write_jsonl(variants.variants(rows, checked), p.variants)
    variants.outcome_counts(checked).coalesce(1).write.mode("overwrite").json(f"{p.out}/idea2/run_summary.json")
    return n


def run_all(spark: SparkSession, p: Paths, cfg: Config = Config(), limit: int | None = None, model: Model | None = None, lookup: crosswalk.Lookup | None = None) -> None:
    build_graph(spark, p, cfg, lookup)
    link_corpus(spark, p, cfg)
    build_instances(spark, p, cfg)
    build_variants(spark, p, cfg, limit, model)
