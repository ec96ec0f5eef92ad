"""Adapter from the driver's tables to the engine's model.

The ontology has a concept for every row of ``part``. Its names and titles are words of the
corpus, dealt to concepts by a hash of the word; its classes, roles, structures and relations
follow the keys of ``part``, a role that a fiftieth of all concepts has among them. A few rows
beside it hold the awkward cases of the flat files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import corpus_text
from .operators import linking, memberships, ontology
from .schema import LANGS, Config
from .shared import is_there, settle
from .sources.readers import parse_obo

ID = "CHEBI:{}"
#: The queries' keys start and end between characters, as in link_native.
WHOLE = Config(whole_characters=True)
COMPOUNDS = ("id chebi_accession name stars parent_id", [
    ("1", "CHEBI:1", "alpha", "3", None), ("2", None, "beta", "3", "100"), ("3", "CHEBI:3", "gamma", "2", "CHEBI:100"), ("4", "CHEBI:4", "delta", "3", ""),
    ("5", "", "epsilon", "2", "101"), ("6", "CHEBI:6", "zeta", "3", "x"), ("7", "CHEBI:7", "null", "1", None), ("7", "CHEBI:7", "eta", "?", "100"), ("bad", None, "none", "3", None),
])
NAMES = ("compound_id name language_code", [
    ("1", "with", "en"), ("1", "With", "en"), ("1", "avec", "fr"), ("1", "mit", "de"), ("1", "con", "es"),
    ("2", "for", None), ("2", "pour", "fr"), ("2", "für", "de"), ("2", "para", "es"),
    ("3", "the", " EN "), ("3", "les", "fr"), ("3", "der", "de"), ("3", "los", "es"),
    ("4", "that", ""), ("4", "que", "fr"), ("4", "que", "es"),
    ("5", "that", "en"), ("5", "qui", "fr"), ("5", "die", "de"), ("5", "que", "es"),
    ("6", "for the", "en"), ("6", "the and", "en"), ("6", "and that", "en"),
    ("6", "of", "en"), ("6", "null", "en"), ("6", "", "en"), ("6", "ja", "ja"), ("?", "none", "en"),
])
STRUCTURES = ("compound_id default_structure standard_inchi standard_inchi_key smiles", [
    ("1", "F", None, "AAAAAAAAAAAAAA-1", "C"), ("1", "F", "I1", None, "CC"), ("1", "F", "I2", "ZZZZZZZZZZZZZZ-9", "CCC"), ("1", "T", "I3", None, None),
    ("3", "t", "I4", "BBBBBBBBBBBBBB-1", ""), ("4", "1", "I5", "BBBBBBBBBBBBBB-2", "O"), ("4", "true", None, None, "OO"), ("5", "F", "I6", "SHORT", None),
])
FORMULAS = ("compound_id formula", [("1", ""), ("1", "C2H6O"), ("1", "C3"), ("3", "NaCl"), ("4", "H2O"), ("6", None)])
RELATION_TYPES = ("id code", [("1", "has_role"), ("2", "has_parent_hydride"), ("3", "is_conjugate_acid_of"), ("4", "is_conjugate_base_of"), ("5", "is_tautomer_of"), ("6", "has_part"), ("7", "")])
RELATIONS = ("relation_type_id init_id final_id status_id", [
    ("1", "1", "24432", "1"), ("1", "2", "24432", "3"), ("1", "4", "23888", "1"), ("1", "5", "23888", None), ("1", "3", "50047", "x"), ("1", "6", "23888", "9"),
    ("2", "2", "200", "1"), ("2", "5", "200", "1"), ("3", "1", "2", "1"), ("4", "2", "1", "3"), ("5", "4", "5", "1"), ("5", "5", "4", "1"), ("5", "3", "3", "1"), ("6", "1", "3", "1"), ("1", "null", "23888", "1"),
])
OBO = [
    "format-version: 1.2", "id: CHEBI:1\nname: one\nis_a: CHEBI:100 ! class", "id: CHEBI:2\nname: two\nis_a: CHEBI:100", "id: CHEBI:3\nname: three\nis_a: CHEBI:100\nis_a: CHEBI:101",
    "id: CHEBI:4\nname: four\nis_a: CHEBI:101", "id: CHEBI:5\nname: five\nis_a: CHEBI:101", "id: CHEBI:6\nname: six\nis_a: CHEBI:101", "id: CHEBI:8\nname: eight",
    "id: CHEBI:9\nname: old\nis_a: CHEBI:100\nis_obsolete: true", "id: CHEBI:100\nname: class\n\n[Typedef]\nid: part\nis_a: CHEBI:1",
]
TITLES = ("chebi_id qid lang title", [("CHEBI:4", "Q4", "de", "dass"), ("CHEBI:2", "Q2", "en", "FOR"), ("CHEBI:2", "Q2", "de", "gegen"), ("CHEBI:8", "Q8", "fr", "aux")])
CACHED = ("key response", [("k0", "old"), ("k1", "une"), ("k0", "new")])


_CONCEPT = "CAST(100000 + p_partkey AS STRING)"
_ROWS = {
    COMPOUNDS[0]: f"SELECT {_CONCEPT} AS id, CAST(NULL AS STRING) AS chebi_accession, p_name AS name, CAST(1 + p_size % 3 AS STRING) AS stars, CASE WHEN p_partkey % 7 = 0 THEN CAST(300000 + p_size AS STRING) END AS parent_id, 1000 + p_partkey AS pos FROM {{part}}",
    NAMES[0]: "SELECT CAST(100000 + h % n AS STRING) AS compound_id, word AS name, lang AS language_code, 1000 + h AS pos FROM {words}, (SELECT count(*) AS n FROM {part}) WHERE CAST(floor(h / 1000) AS BIGINT) % 10 <> 0",
    STRUCTURES[0]: f"SELECT {_CONCEPT} AS compound_id, CASE WHEN p_partkey % 5 = 0 THEN 'F' ELSE 'T' END AS default_structure, concat('I', p_partkey) AS standard_inchi, concat(substr(upper(md5(concat(p_brand, '|', p_type, '|', p_size))), 1, 14), '-', p_partkey) AS standard_inchi_key, CASE WHEN p_size > 9 THEN 'C' END AS smiles, 1000 + p_partkey AS pos FROM {{part}}",
    FORMULAS[0]: f"SELECT {_CONCEPT} AS compound_id, concat('C', p_size, 'H', p_partkey % 40) AS formula, 1000 + p_partkey AS pos FROM {{part}}",
    RELATIONS[0]: " UNION ALL ".join(
        f"SELECT '{kind}' AS relation_type_id, {_CONCEPT} AS init_id, CAST({to} AS STRING) AS final_id, CASE p_partkey % 9 WHEN 0 THEN '9' WHEN 1 THEN '3' ELSE '1' END AS status_id, {k}000000 + p_partkey AS pos FROM {{part}} WHERE {where}"
        for k, (kind, to, where) in enumerate([
            (1, "400000 + CAST(floor(p_partkey / 10) AS BIGINT)", "p_size > 5"), (1, "60027", "p_partkey % 50 = 1"), (2, "500000 + CAST(floor(p_partkey / 6) AS BIGINT)", "p_size % 2 = 0"),
            (3, "100001 + p_partkey", "p_partkey % 10 = 3"), (4, "99999 + p_partkey", "p_partkey % 10 = 4"), (5, "100001 + p_partkey", "p_partkey % 10 = 5"), (5, "99999 + p_partkey", "p_partkey % 10 = 6"),
        ], 1)
    ),
    TITLES[0]: "SELECT concat('CHEBI:', 100000 + h % n) AS chebi_id, concat('Q', h) AS qid, lang, word AS title, 1000 + h AS pos FROM {words}, (SELECT count(*) AS n FROM {part}) WHERE CAST(floor(h / 1000) AS BIGINT) % 10 = 0",
}
#: A stanza for each part: a class of eight, for some a class by size too; some are obsolete.
STANZAS = (
    "SELECT concat('id: CHEBI:', 100000 + p_partkey, chr(10), 'name: ', p_name, chr(10), 'is_a: CHEBI:', 600000 + CAST(floor(p_partkey / 8) AS BIGINT), ' ! class', "
    "CASE WHEN p_partkey % 4 = 0 THEN concat(chr(10), 'is_a: CHEBI:', 700000 + p_size) ELSE '' END, CASE WHEN p_partkey % 101 = 0 THEN concat(chr(10), 'is_obsolete: true') ELSE '' END) AS value FROM {part}"
)
#: Words of so many letters, a quarter of them by hash, are names.
WORD = r"\p{L}{6,}"


def values(table: tuple[str, list[tuple]]) -> str:
    """Rows as SQL, the same in Spark and DuckDB, with their order in pos."""
    quote = lambda x: "CAST(NULL AS STRING)" if x is None else "'" + x.replace("'", "''") + "'"
    rows = ", ".join("(" + ", ".join(map(quote, r)) + f", CAST({k} AS BIGINT))" for k, r in enumerate(table[1]))
    fixed = f"SELECT * FROM (VALUES {rows}) AS t({', '.join([*table[0].split(), 'pos'])})"
    return f"({fixed} UNION ALL {_ROWS[table[0]]})" if table[0] in _ROWS else f"({fixed})"


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, word, h): the corpus's words that are names, with a hash."""
    each = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0))).alias("word")).distinct()
    h = F.conv(F.substring(F.md5("word"), 1, 13), 16, 10).cast("long")
    return each.withColumn("h", h).where("CAST(floor(h / 7) AS BIGINT) % 4 = 0")


_WORDS: dict[tuple[str, str], tuple[DataFrame, str]] = {}


def held_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, settled: names, titles and all that follows from them need no corpus."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WORDS or not is_there(spark, _WORDS[key][1]):
        _WORDS[key] = settle(words(spark, sf_dir), "words")
    return _WORDS[key][0]


def _sql(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    tables = {"part": lambda: spark.read.parquet(f"{sf_dir}/part.parquet"), "words": lambda: held_words(spark, sf_dir)}
    return spark.sql(query, **{k: make() for k, make in tables.items() if f"{{{k}}}" in query})


def raw(spark: SparkSession, sf_dir: str, table: tuple[str, list[tuple]]) -> DataFrame:
    return _sql(spark, sf_dir, f"SELECT * FROM {values(table)}")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as corpus rows: four consecutive ids are one publication; lines are fields."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    group = F.floor(F.col("doc_id") / 4).cast("string")
    line = lambda k: F.coalesce(F.get(lines, F.lit(k)), F.lit(""))
    rest = F.when(F.size(lines) > 2, F.array_join(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))), "\n")).otherwise("")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat_ws("_", group, "lang", F.col("doc_id").cast("string")).alias("id"), F.col("lang").alias("language"), line(0).alias("title"), line(1).alias("abstract"),
        rest.alias("description"), F.lit("").alias("first_claim"), F.lit("").alias("context"), group.alias("publication_number"),
    )


def lexicon(docs: DataFrame) -> DataFrame:
    """A made-up lexicon of the corpus's own words: a term is the word backwards, then the language."""
    words = docs.select("language", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}"), 0))).alias("word")).distinct()
    swaps = words.withColumn("swap_lang", F.explode(F.array(*(F.lit(x) for x in LANGS)))).where("swap_lang <> language")
    return swaps.select(F.col("language").alias("lang"), "word", "swap_lang", F.concat(F.reverse("word"), "swap_lang").alias("term"))


def documents(rows: DataFrame) -> DataFrame:
    return rows.select("id", "publication_number", "language", corpus_text().alias("text"))


def stanzas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): the ontology file's parts."""
    fixed = spark.sql("SELECT * FROM VALUES " + ", ".join("('" + x.replace("\n", "\\n") + "')" for x in OBO) + " AS t(value)")
    return fixed.unionByName(_sql(spark, sf_dir, STANZAS))


def folded(text: F.Column) -> F.Column:
    """The same as full folding for what the corpus has, in the JVM."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


class Graph:
    """The ontology, parsed."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        low = folded(F.col("alias"))
        table = lambda t: raw(spark, sf_dir, t)
        self.terms = parse_obo(stanzas(spark, sf_dir))
        self.compounds = ontology.parse_compounds(table(COMPOUNDS))
        self.structures = ontology.parse_structures(table(STRUCTURES))
        self.formulas = ontology.parse_chemical_data(table(FORMULAS))
        self.nodes = ontology.merge_nodes(self.terms, self.compounds, self.structures, self.formulas)
        self.relations = ontology.parse_relations(table(RELATIONS), table(RELATION_TYPES))
        self.edges = ontology.is_a_edges(self.terms).unionByName(self.relations)
        self.aliases = ontology.parse_names(table(NAMES), low)
        self.titles = table(TITLES).drop("pos")
        self.combined = ontology.aliases_combined(self.aliases, self.titles, low)
        self.dictionary = linking.invert(self.combined, Config(), low)


class Linked:
    """Corpus, graph, links and the graph's slice; each is settled when first asked for, and shared by a session's queries."""

    _held: dict[tuple[str, str], Linked] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Linked:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._held or not all(is_there(spark, p) for p in cls._held[key].paths):
            cls._held[key] = cls(spark, sf_dir)
        return cls._held[key]

    @classmethod
    def forget(cls, spark: SparkSession) -> None:
        """Links of this session's queries are made anew."""
        for held in (cls._held, _WORDS):
            for key in [k for k in held if k[0] == spark.sparkContext.applicationId]:
                held.pop(key)

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.paths: list[str] = []
        self.graph = Graph(spark, sf_dir)
        self.corpus = corpus(spark, sf_dir)
        self.docs = documents(self.corpus)
        self.linked = self._settled(linking.link_exact(self.docs, self.graph.dictionary, WHOLE), "linked")

    def _settled(self, df: DataFrame, name: str) -> DataFrame:
        out, path = settle(df, name)
        self.paths.append(path)
        return out

    def _slice(self, lists: bool) -> DataFrame:
        g = self.graph
        return ontology.concept_slice(g.nodes, g.edges, g.aliases, g.combined, self.mentioned, g.titles, lists)

    @cached_property
    def mentioned(self) -> DataFrame:
        return self._settled(linking.mentioned_ids(self.linked), "mentioned")

    @cached_property
    def concepts(self) -> DataFrame:
        """With lists of neighbors."""
        return self._settled(self._slice(True), "concepts")

    @cached_property
    def slim(self) -> DataFrame:
        """Without, for what asks memberships for neighbors or needs none."""
        return self._settled(self._slice(False), "slim")

    @cached_property
    def member(self) -> DataFrame:
        return self._settled(memberships.memberships(self.graph.nodes, self.graph.edges), "member")

    @cached_property
    def direct(self) -> DataFrame:
        return self._settled(memberships.links(self.graph.edges), "direct")
