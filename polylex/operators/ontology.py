"""The concept graph: parsing flat files, neighbor relations, alias union, the slice of mentioned concepts.

Raw tables are all strings with ``pos``, the order of their rows, which decides every tie.
Nodes are one table, aliases one (chebi_id, lang, pos, alias), edges one (src, rel, dst).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold, normalize_id
from ..schema import LANGS, RELATIONS

# Statuses of relations that count, and the relations read from the flat files.
STATUSES = ("1", "3")
CODES = ("has_role", "has_parent_hydride", "is_conjugate_acid_of", "is_conjugate_base_of", "is_tautomer_of")
#: Members of a group that meet as many others in a cell.
CELL = 1024


def _sql(query: str, **tables: DataFrame) -> DataFrame:
    return next(iter(tables.values())).sparkSession.sql(query, **tables)


def _given(c: str) -> Column:
    """Trimmed, with the empty string as null."""
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def _last(c: Column, name: str) -> Column:
    """The last value that is not null, by pos."""
    return F.max_by(c, F.when(c.isNotNull(), F.col("pos"))).alias(name)


def parse_compounds(raw: DataFrame) -> DataFrame:
    """(chebi_id, name, star, parent_id): the last row of a concept holds, each column for itself."""
    x = raw.withColumn("chebi_id", normalize_id(F.coalesce(F.nullif("chebi_accession", F.lit("")), "id"))).where("chebi_id is not null")
    name = F.when((F.col("name") != "") & (F.col("name") != "null"), F.col("name"))
    star = F.when(F.trim("stars").rlike(r"^\d+$"), F.trim("stars").cast("int"))
    return x.groupBy("chebi_id").agg(_last(name, "name"), _last(star, "star"), F.max_by(normalize_id(F.col("parent_id")), "pos").alias("parent_id"))


def dedup_aliases(rows: DataFrame, fold_with: Column | None = None) -> DataFrame:
    """(chebi_id, lang, pos, alias): the first of those that fold alike; empty ones go."""
    key = F.when(F.col("lang") == "zh", F.col("alias")).otherwise(fold("alias", "lang") if fold_with is None else fold_with)
    first = F.row_number().over(Window.partitionBy("chebi_id", "lang", "__key").orderBy("pos"))
    return rows.where("alias <> ''").withColumn("__key", key).withColumn("__n", first).where("__n = 1").select("chebi_id", "lang", "pos", "alias")


def parse_names(raw: DataFrame, fold_with: Column | None = None) -> DataFrame:
    """(chebi_id, lang, pos, alias): a missing language is English; other languages go."""
    lang = F.coalesce(F.nullif(F.lower(F.trim("language_code")), F.lit("")), F.lit("en"))
    x = raw.select(normalize_id(F.col("compound_id")).alias("chebi_id"), lang.alias("lang"), "pos", F.col("name").alias("alias"))
    x = x.where(F.col("chebi_id").isNotNull() & F.col("lang").isin(*LANGS) & (F.col("alias") != "null"))
    return dedup_aliases(x, fold_with)


def parse_structures(raw: DataFrame) -> DataFrame:
    """(chebi_id, inchi, inchikey, smiles): a row counts if it is the default, or until an InChI is known; the last counts."""
    is_default = F.coalesce(F.upper(F.trim("default_structure")).isin("T", "TRUE", "1"), F.lit(False))
    x = raw.select(normalize_id(F.col("compound_id")).alias("chebi_id"), "pos", is_default.alias("d"), _given("standard_inchi").alias("inchi"), _given("standard_inchi_key").alias("inchikey"), _given("smiles").alias("smiles")).where("chebi_id is not null")
    known = F.min(F.when(F.col("inchi").isNotNull(), F.col("pos"))).over(Window.partitionBy("chebi_id"))
    x = x.withColumn("known", known).where("d or known is null or pos <= known")
    return x.groupBy("chebi_id").agg(*(_last(F.col(c), c) for c in ("inchi", "inchikey", "smiles")))


def parse_chemical_data(raw: DataFrame) -> DataFrame:
    """(chebi_id, formula): the first that is given."""
    x = raw.select(normalize_id(F.col("compound_id")).alias("chebi_id"), "pos", _given("formula").alias("formula"))
    return x.where("chebi_id is not null and formula is not null").groupBy("chebi_id").agg(F.min_by("formula", "pos").alias("formula"))


def parse_relations(raw: DataFrame, types: DataFrame) -> DataFrame:
    """(src, rel, dst, pos): relations of the codes kept, of a status that counts or without a number for it."""
    codes = types.select(_given("id").alias("t"), _given("code").alias("rel")).where(F.col("rel").isin(*CODES))
    status = F.trim("status_id")
    x = raw.where(F.coalesce(~status.rlike(r"^\d+$") | status.cast("int").isin(*map(int, STATUSES)), F.lit(True)))
    x = x.select(F.trim("relation_type_id").alias("t"), normalize_id(F.col("init_id")).alias("src"), normalize_id(F.col("final_id")).alias("dst"), "pos")
    return x.join(codes, "t").where("src is not null and dst is not null").select("src", "rel", "dst", "pos")


def is_a_edges(terms: DataFrame) -> DataFrame:
    """(src, rel, dst, pos) from the ontology's terms: child to parent."""
    return terms.select(F.col("id").alias("src"), F.lit("is_a").alias("rel"), F.posexplode("parents").alias("pos", "dst")).select("src", "rel", "dst", F.col("pos").cast("long").alias("pos"))


def merge_nodes(terms: DataFrame, compounds: DataFrame, structures: DataFrame, formulas: DataFrame) -> DataFrame:
    """One row for each concept; the compounds' name comes before the ontology's."""
    t = terms.select(F.col("id").alias("chebi_id"), F.col("name").alias("obo_name"))
    x = t.join(compounds, "chebi_id", "full").join(structures, "chebi_id", "full").join(formulas, "chebi_id", "full")
    return x.select("chebi_id", F.coalesce("name", "obo_name").alias("name"), "star", "parent_id", "inchi", "inchikey", "smiles", "formula")


def all_ids(*tables: DataFrame) -> DataFrame:
    """The distinct concepts of some tables."""
    out = tables[0].select("chebi_id")
    for t in tables[1:]:
        out = out.unionByName(t.select("chebi_id"))
    return out.where("chebi_id is not null").distinct()


def aliases_combined(aliases: DataFrame, titles: DataFrame | None = None, fold_with: Column | None = None) -> DataFrame:
    """Names, then titles, deduplicated in this order: (chebi_id, lang, pos, alias)."""
    if titles is None:
        return aliases
    first = F.row_number().over(Window.partitionBy("chebi_id", "lang").orderBy("qid", "title"))
    t = titles.withColumn("n", first).where("n = 1").select("chebi_id", "lang", F.lit(1 << 60).alias("pos"), F.col("title").alias("alias"))
    return dedup_aliases(aliases.unionByName(t), fold_with)


def _siblings(edges: DataFrame, of: DataFrame | None, relation: str) -> DataFrame:
    """(chebi_id, neighbor, relation) for edges (c, k): concepts with one k. ``of`` keeps left sides only, before the join.

    Both sides of a large group are dealt into cells of about ``CELL``, and any two cells meet by themselves. A pair
    comes from the least k that both concepts have, so it comes once and pairs are not exchanged.
    """
    sets = edges.where("c is not null and k is not null").groupBy("c").agg(F.sort_array(F.collect_set("k")).alias("ks"))
    each = sets.select("c", F.when(F.size("ks") > 1, F.col("ks")).alias("ks"), F.explode("ks").alias("k"))
    each = each.join(each.groupBy("k").agg(F.ceil(F.count("*") / CELL).alias("cells")), "k")
    own, every = F.pmod(F.xxhash64("c"), F.col("cells")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))
    left = each if of is None else each.join(of.select(F.col("chebi_id").alias("c")), "c", "left_semi")
    left = left.select("k", "c", "ks", own.alias("a"), every.alias("b"))
    right = each.select("k", F.col("c").alias("neighbor"), F.col("ks").alias("theirs"), own.alias("b"), every.alias("a"))
    once = F.col("ks").isNull() | F.col("theirs").isNull() | (F.get(F.array_intersect("ks", "theirs"), F.lit(0)) == F.col("k"))
    return left.join(right, ["k", "a", "b"]).where((F.col("c") != F.col("neighbor")) & once).select(F.col("c").alias("chebi_id"), "neighbor", F.lit(relation).alias("relation"))


def with_siblings(x: DataFrame, groups: dict[str, DataFrame]) -> DataFrame:
    """x (chebi_id, ...) with a sorted list by each name: who has a k in common by its edges (c, k), empty where there is none.

    Pairs are not exchanged: a group's members are one list, which meets those whose largest group it is, in cells of
    about ``CELL`` of them. Members of a concept's other groups come to it first, so lists are formed where they end.
    """
    lists = {}
    for name, edges in groups.items():
        each = edges.where("c is not null and k is not null").distinct()
        members = each.groupBy("k").agg(F.sort_array(F.collect_list("c")).alias("members")).withColumn("n", F.size("members"))
        own = each.join(members.select("k", "n"), "k")
        home = own.groupBy("c").agg(F.max(F.struct("n", "k")).alias("home"), F.count("*").alias("of"))
        rest = own.join(home.where("of > 1").select("c", "home"), "c").where("k <> home.k").select("c", "k").join(members, "k")
        rest = rest.groupBy("c").agg(F.array_distinct(F.flatten(F.collect_list("members"))).alias(f"{name}_rest"))
        cells = F.ceil(F.col("home.n") / CELL)
        home = home.join(rest, "c", "left").select(F.col("c").alias("chebi_id"), F.col("home.k").alias(f"{name}_k"), F.pmod(F.xxhash64("c"), cells).alias(f"{name}_cell"), f"{name}_rest")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / CELL) - 1))
        lists[name] = members.select(F.col("k").alias(f"{name}_k"), every.alias(f"{name}_cell"), "members")
        x = x.join(home, "chebi_id", "left")
    for name, members in lists.items():
        both = F.when(F.col(f"{name}_rest").isNull(), F.col("members")).otherwise(F.sort_array(F.array_union("members", f"{name}_rest")))
        found = F.coalesce(F.array_remove(both, F.col("chebi_id")), F.array().cast("array<string>"))
        x = x.join(members, [f"{name}_k", f"{name}_cell"], "left").withColumn(name, found).drop("members", *(f"{name}_{c}" for c in ("k", "cell", "rest")))
    return x


def _grouped(edges: DataFrame, rel: str) -> DataFrame:
    return edges.where(F.col("rel") == rel).select(F.col("src").alias("c"), F.col("dst").alias("k"))


def siblings_isa(edges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    return _siblings(_grouped(edges, "is_a"), of, RELATIONS[0])


def siblings_role(edges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    return _siblings(_grouped(edges, "has_role"), of, RELATIONS[1])


def conjugate_pair(edges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    return _linked(edges, ("is_conjugate_acid_of", "is_conjugate_base_of"), of, RELATIONS[2])


def tautomers(edges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    return _linked(edges, ("is_tautomer_of",), of, RELATIONS[3])


def _linked(edges: DataFrame, codes: tuple[str, ...], of: DataFrame | None, relation: str) -> DataFrame:
    x = edges.where(F.col("rel").isin(*codes) & (F.col("src") != F.col("dst"))).select(F.col("src").alias("chebi_id"), F.col("dst").alias("neighbor"), F.lit(relation).alias("relation")).distinct()
    return x if of is None else x.join(of, "chebi_id", "left_semi")


def inchikey_block(nodes: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Concepts whose keys begin with the same 14 characters."""
    return _siblings(_keyed(nodes), of, RELATIONS[4])


def _keyed(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.length("inchikey") >= 14).select(F.col("chebi_id").alias("c"), F.substring("inchikey", 1, 14).alias("k"))


def parent_hydride_family(edges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    return _siblings(_grouped(edges, "has_parent_hydride"), of, RELATIONS[5])


def neighbors(nodes: DataFrame, edges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(chebi_id, neighbor, relation, prio) over all six relations; ``of`` (chebi_id) restricts the left side first."""
    parts = [siblings_isa(edges, of), siblings_role(edges, of), conjugate_pair(edges, of), tautomers(edges, of), inchikey_block(nodes, of), parent_hydride_family(edges, of)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("prio", F.array_position(F.array(*(F.lit(r) for r in RELATIONS)), F.col("relation")).cast("int"))


def all_neighbors(near: DataFrame) -> DataFrame:
    return near.select("chebi_id", "neighbor").distinct()


def all_pairs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """all_neighbors of neighbors: groups of all relations at once, and the links that no group has, so that pairs in groups are not exchanged."""
    kinds = {"is_a": _grouped(edges, "is_a"), "role": _grouped(edges, "has_role"), "key": _keyed(nodes), "hydride": _grouped(edges, "has_parent_hydride")}
    parts = [x.select("c", F.concat(F.lit(kind + "|"), "k").alias("k")) for kind, x in kinds.items()]
    groups = parts[0]
    for x in parts[1:]:
        groups = groups.unionByName(x)
    linked = conjugate_pair(edges).unionByName(tautomers(edges)).select("chebi_id", "neighbor").distinct()
    both = linked.join(groups.withColumnRenamed("c", "chebi_id"), "chebi_id").join(groups.withColumnRenamed("c", "neighbor"), ["neighbor", "k"], "left_semi")
    return _siblings(groups, None, "").select("chebi_id", "neighbor").unionByName(linked.join(both.select("chebi_id", "neighbor").distinct(), ["chebi_id", "neighbor"], "left_anti"))


def alias_lists(aliases: DataFrame, name: str) -> DataFrame:
    """(chebi_id, name): a struct with the ordered list of each language, empty where there is none."""
    lists = [F.transform(F.array_sort(F.collect_list(F.when(F.col("lang") == x, F.struct("pos", "alias")))), lambda s: s["alias"]).alias(x) for x in LANGS]
    return aliases.groupBy("chebi_id").agg(F.struct(*lists).alias(name))


def _empty_lists() -> Column:
    return F.struct(*(F.array().cast("array<string>").alias(x) for x in LANGS))


def concept_slice(nodes: DataFrame, edges: DataFrame, aliases: DataFrame, combined: DataFrame, mentioned: DataFrame, titles: DataFrame | None = None, lists: bool = True) -> DataFrame:
    """The graph artifact: a row for each concept in mentioned (chebi_id), by left joins on the concept. Without lists, neighbors are left out (see memberships)."""
    spark = nodes.sparkSession
    of = mentioned.select("chebi_id").distinct()
    direct = edges.where("rel in ('is_a', 'has_role')").join(of.withColumnRenamed("chebi_id", "src"), "src", "left_semi")
    ordered = lambda rel: F.transform(F.array_sort(F.collect_list(F.when(F.col("rel") == rel, F.struct("pos", "dst")))), lambda s: s["dst"])
    direct = direct.groupBy(F.col("src").alias("chebi_id")).agg(ordered("is_a").alias("parents_isa"), ordered("has_role").alias("roles"))
    pairs = conjugate_pair(edges, of).unionByName(tautomers(edges, of))
    near = pairs.groupBy("chebi_id").agg(*(F.sort_array(F.collect_set(F.when(F.col("relation") == r, F.col("neighbor")))).alias(r) for r in RELATIONS[2:4]))
    # the lists that may be long come last, as rows are exchanged with those before
    groups = {RELATIONS[4]: _keyed(nodes), RELATIONS[5]: _grouped(edges, "has_parent_hydride"), RELATIONS[0]: _grouped(edges, "is_a"), RELATIONS[1]: _grouped(edges, "has_role")}
    none = "chebi_id string, qid string, lang string, title string"
    t = (titles if titles is not None else spark.createDataFrame([], none)).groupBy("chebi_id").agg(F.min("qid").alias("wikidata_qid"), F.struct(*(F.min(F.when(F.col("lang") == x, F.col("title"))).alias(x) for x in LANGS)).alias("wikipedia_titles"))
    x = of.join(nodes, "chebi_id", "left")
    for part in (alias_lists(aliases, "aliases_chebi"), t, alias_lists(combined, "aliases_combined"), direct, *([near] if lists else [])):
        x = x.join(part, "chebi_id", "left")
    if lists:
        x = with_siblings(x, groups)
    else:
        x = x.select("*", *(F.array().cast("array<string>").alias(r) for r in RELATIONS))
    empty = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c)
    no_titles = F.struct(*(F.lit(None).cast("string").alias(y) for y in LANGS))
    return x.select(
        "chebi_id", F.col("name").alias("chebi_name_en"), "inchikey", "inchi", "smiles", "formula", F.col("star").alias("chebi_star"),
        F.coalesce("aliases_chebi", _empty_lists()).alias("aliases_chebi"), "wikidata_qid", F.coalesce("wikipedia_titles", no_titles).alias("wikipedia_titles"),
        F.coalesce("aliases_combined", _empty_lists()).alias("aliases_combined"), *(empty(c) for c in ("parents_isa", "roles", *RELATIONS)),
    )


def aliases_of_slice(concepts: DataFrame) -> DataFrame:
    """(chebi_id, lang, pos, alias) from the artifact's combined lists."""
    parts = [concepts.select("chebi_id", F.lit(x).alias("lang"), F.posexplode(F.col("aliases_combined")[x]).alias("pos", "alias")) for x in LANGS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("pos", F.col("pos").cast("long"))


def neighbors_of_slice(concepts: DataFrame) -> DataFrame:
    """(chebi_id, neighbor, relation, prio) from the artifact's lists."""
    each = F.array(*(F.struct(F.lit(r).alias("relation"), F.lit(k + 1).alias("prio"), F.col(r).alias("n")) for k, r in enumerate(RELATIONS)))
    return concepts.select("chebi_id", F.explode(each).alias("x")).select("chebi_id", F.explode("x.n").alias("neighbor"), "x.relation", "x.prio")
