"""Document variants: a source row with one term exchanged, verified.

A cell is a source row with a variant and a position. Cells flow through one chain of
columns: eligible language, position, picked mention, term from the provider, splice, checks.
A cell that fails keeps its ``reject_reason``, so counts are an aggregate of the same table.

Tags: A_clean, B_in_set, C_out_of_set, D_noisy, E_control_nonchem.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schema import POSITIONS, VARIANT, Config
from . import sentences


def available_languages(corpus: DataFrame) -> DataFrame:
    """(publication_number, l_avail): sorted languages of a publication."""
    return corpus.groupBy("publication_number").agg(F.sort_array(F.collect_set("language")).alias("l_avail"))


def qualifying_rows(linked: DataFrame, l_avail: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Linked rows with a mention and enough tokens, with the publication's languages."""
    x = linked.where((F.size("mentions") > 0) & (tx.token_count(F.col("text"), F.col("language")) >= cfg.min_tokens))
    return x.join(l_avail, "publication_number")


def choose_rows(rows: DataFrame, cfg: Config = Config(), limit: int | None = None) -> DataFrame:
    """(id, publication_number, l_avail) of one row for each publication; those with two or three languages first.

    Only ids are exchanged: the least hash of a publication, then the first of all.
    """
    best = F.min_by(F.struct("id", "l_avail"), F.struct(tx.md5_key(cfg.seed, "row", F.col("id")), "id")).alias("r")
    x = rows.select("id", "publication_number", "l_avail").groupBy("publication_number").agg(best).select("r.id", "publication_number", "r.l_avail")
    x = x.orderBy(F.when(F.size("l_avail").isin(2, 3), 0).otherwise(1), tx.md5_key(cfg.seed, "pub", F.col("publication_number")), "publication_number").limit(cfg.bench2_target)
    return x if limit is None else x.limit(limit)


def sample_rows(linked: DataFrame, l_avail: DataFrame, cfg: Config = Config(), limit: int | None = None) -> DataFrame:
    """The chosen of the qualifying rows, with l_avail: texts stay where they are, as the choice is broadcast."""
    chosen = choose_rows(qualifying_rows(linked, l_avail, cfg), cfg, limit).select("id", "l_avail")
    return linked.join(F.broadcast(chosen), "id")  # bench2_target rows at most


def with_fields(sample: DataFrame, corpus: DataFrame) -> DataFrame:
    """The sample with its corpus rows' fields."""
    return corpus.select("id", *tx.TEXT_FIELDS).join(F.broadcast(sample), "id")  # bench2_target rows at most


def with_positions(rows: DataFrame, abbreviations: DataFrame | None = None) -> DataFrame:
    """rows with ``ranges``: title, first sentence and body within the joined text (start, end; null where there is none).

    With abbreviations (sentences.abbreviations of the corpus), sentences end by what they show; without, at the first mark.
    """
    span = tx.field_spans()
    given = lambda f: F.coalesce(F.col(f), F.lit(""))
    full = lambda f: F.trim(given(f), F.lit(" \n\t\r")) != ""
    none = F.lit(None).cast("struct<start:int,end:int>")
    piece = lambda a, z: F.struct(a.cast("int").alias("start"), z.cast("int").alias("end"))
    if abbreviations is None:
        sentence = lambda f: piece(span[f]["start"], span[f]["start"] + F.length(tx.first_sentence(given(f))))
    else:
        lead = F.when(full("abstract"), F.col("abstract")).otherwise(given("description"))
        rows = rows.withColumn("__end", sentences.first_sentence_end(lead, F.col("language"), abbreviations))
        sentence = lambda f: piece(span[f]["start"], span[f]["start"] + F.col("__end"))
    first = F.when(full("abstract"), sentence("abstract")).when(full("description"), sentence("description")).otherwise(none)
    x = rows.withColumn("__fs", first)
    fs = F.col("__fs")

    def body(f: str) -> Column:
        a, z = span[f]["start"], span[f]["end"]
        inside = (fs["start"] >= a) & (fs["start"] < z)
        return piece(F.when(F.coalesce(inside, F.lit(False)), fs["end"]).otherwise(a), z)

    bodies = F.filter(F.array(*(body(f) for f in ("description", "first_claim", "context"))), lambda r: r["end"] > r["start"])
    ranges = F.struct(F.when(full("title"), piece(span["title"]["start"], span["title"]["end"])).otherwise(none).alias("title"), fs.alias("first_sentence"), bodies.alias("body"))
    return x.withColumn("ranges", ranges).drop("__fs", "__end")


def position_of(offset: Column, ranges: Column) -> Column:
    """title, first_sentence, body or null."""
    within = lambda r: (offset >= r["start"]) & (offset < r["end"])
    return F.when(within(ranges["title"]), "title").when(within(ranges["first_sentence"]), "first_sentence").when(F.exists(ranges["body"], within), "body")


def cells(rows: DataFrame, cfg: Config = Config()) -> DataFrame:
    """A row for each source row, variant and position, with the language to swap to."""
    grid = [("B_in_set", p) for p in POSITIONS] + [("C_out_of_set", p) for p in POSITIONS] + [("D_noisy", "body"), ("E_control_nonchem", "body")]
    x = rows.withColumn("cell", F.explode(F.array(*(F.struct(F.lit(v).alias("variant"), F.lit(p).alias("position")) for v, p in grid))))
    x = x.withColumns({"variant": F.col("cell.variant"), "position": F.col("cell.position")}).drop("cell")
    key = ("lang", F.col("id"), F.col("variant"), F.col("position"))
    ins, outs = tx.swap_lang_in_set(F.col("l_avail"), F.col("language"), cfg.seed, *key), tx.swap_lang_out_of_set(F.col("l_avail"), cfg.seed, *key)
    styles = F.filter(F.array(F.when(ins.isNotNull(), F.lit("in_set")), F.when(outs.isNotNull(), F.lit("out_of_set"))), lambda s: s.isNotNull())
    style = F.when(F.col("variant") == "E_control_nonchem", tx.least_hashed(styles, cfg.seed, "style", F.col("id")))
    x = x.withColumn("control_style", style)
    by = F.when(F.col("variant") == "B_in_set", ins).when(F.col("variant") == "C_out_of_set", outs).when(F.col("variant") == "D_noisy", F.col("language"))
    lang = by.when(F.col("control_style") == "in_set", ins).when(F.col("control_style") == "out_of_set", outs)
    return x.withColumn("swap_lang", lang).where("swap_lang is not null")


def parallel_rows(linked: DataFrame, sample: DataFrame) -> DataFrame:
    """(publication_number, swap_lang, parallel, parallel_text): of the sample's publications, the first row in each language, with its mentions."""
    wanted = F.broadcast(sample.select("publication_number").distinct())  # bench2_target rows at most
    first = linked.select("id", "publication_number", "language").join(wanted, "publication_number", "left_semi").groupBy("publication_number", "language").agg(F.min("id").alias("id"))
    x = linked.join(F.broadcast(first.select("id")), "id", "left_semi")  # a row for each of these and each language
    return x.select("publication_number", F.col("language").alias("swap_lang"), F.col("mentions").alias("parallel"), F.col("text").alias("parallel_text"))


def pick_mentions(cell: DataFrame, freq: DataFrame, parallel: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Cells of B, C and D with the mention to exchange: the least tier, then the least hash; fallback says that the first tier was empty."""
    x = cell.where("variant <> 'E_control_nonchem'")
    p = parallel.select("publication_number", "swap_lang", F.transform("parallel", lambda m: m["chebi_id"]).alias("__in"), "parallel", "parallel_text")
    x = x.join(p, ["publication_number", "swap_lang"], "left")
    m = x.select("id", "variant", "position", F.coalesce("__in", F.array().cast("array<string>")).alias("__in"), "ranges", F.explode("mentions").alias("m"))
    m = m.where(position_of(F.col("m.start"), F.col("ranges")) == F.col("position"))
    m = m.join(freq.select(F.col("chebi_id").alias("__c"), "freq"), F.col("m.chebi_id") == F.col("__c"), "left")
    beside = (F.col("variant") != "B_in_set") | F.array_contains("__in", F.col("m.chebi_id"))
    tier = F.when(beside & (F.coalesce("freq", F.lit(0)) >= cfg.freq_floor), 0).when(beside, 1).otherwise(2)
    order = F.struct(tier.alias("tier"), tx.md5_key(cfg.seed, "pick", F.col("id"), F.col("variant"), F.col("position"), F.col("m.start")).alias("k"))
    best = m.withColumn("o", order).groupBy("id", "variant", "position").agg(F.min_by("m", "o").alias("m"), F.min("o.tier").alias("tier"))
    best = best.select("id", "variant", "position", F.col("m.surface").alias("original_term"), F.col("m.start").alias("swap_start"), F.col("m.end").alias("swap_end"), F.col("m.chebi_id").alias("chebi_id"), (F.col("tier") > 0).alias("fallback_flag"))
    return x.drop("__in").join(best, ["id", "variant", "position"], "left")


def word_spans(rows: DataFrame) -> DataFrame:
    """(id, w, start, end): the words of four letters or more, by a running sum over the text's pieces."""
    x = rows.select("id", F.posexplode(F.regexp_extract_all("text", F.lit(r"[\p{L}]+|[^\p{L}]+"), 0)).alias("i", "w"))
    end = F.sum(F.length("w")).over(Window.partitionBy("id").orderBy("i")).cast("int")
    x = x.withColumn("end", end).withColumn("start", (F.col("end") - F.length("w")).cast("int"))
    return x.where(F.col("w").rlike(r"^\p{L}{4,}$")).select("id", "w", "start", "end")


def pick_words(cell: DataFrame, cfg: Config = Config(), nouns: DataFrame | None = None) -> DataFrame:
    """Cells of E with a word of the body that no mention touches; with nouns (nouns.noun_words of the corpus), one of those."""
    x = cell.where("variant = 'E_control_nonchem'")
    t = word_spans(x.select("id", "text")).join(x.select("id", "language", "mentions", "ranges"), "id")
    if nouns is not None:
        known = nouns.select(F.col("lang").alias("language"), F.col("word").alias("__noun"))
        t = t.withColumn("__noun", F.lower("w")).join(known, ["language", "__noun"], "left_semi")
    inside = F.exists("ranges.body", lambda r: (r["start"] <= F.col("start")) & (F.col("end") <= r["end"]))
    touched = F.exists("mentions", lambda m: (F.col("start") < m["end"]) & (F.col("end") > m["start"]))
    t = t.where(inside & ~touched).withColumn("k", tx.md5_key(cfg.seed, "noun", F.col("id"), F.col("start")))
    best = t.groupBy("id").agg(F.min_by(F.struct("w", "start", "end"), "k").alias("t"))
    best = best.select("id", F.col("t.w").alias("original_term"), F.col("t.start").alias("swap_start"), F.col("t.end").alias("swap_end"))
    return x.join(best, "id", "left").withColumns({"chebi_id": F.lit(None).cast("string"), "fallback_flag": F.lit(False)})


def noisy(term: Column, seed: int, *key: Column | str) -> Column:
    """One change of spelling, chosen by hash among those that change the term."""
    n = F.length(term)
    half = F.floor(n / 2).cast("int")
    vowel = F.regexp_extract(term, r"(?i)^([^aeiou]*)([aeiou])", 1)
    swap = F.concat(F.substr(term, F.lit(1), half - 1), F.substr(term, half + 1, F.lit(1)), F.substr(term, half, F.lit(1)), F.substr(term, half + 2))
    changes = {
        "hyphen": F.concat(F.substr(term, F.lit(1), half), F.lit("-"), F.substr(term, half + 1)),
        "vowel": F.when(term.rlike("(?i)[aeiou]"), F.concat(vowel, F.substr(term, F.length(vowel) + 2))),
        "adjacent": swap,
        "case": F.concat(F.substr(term, F.lit(1), half), F.upper(F.substr(term, half + 1, F.lit(1))), F.substr(term, half + 2)),
        "greek": F.replace(F.replace(F.replace(term, F.lit("α"), F.lit("alpha")), F.lit("β"), F.lit("beta")), F.lit("γ"), F.lit("gamma")),
        "oxidation": F.regexp_replace(F.regexp_replace(F.regexp_replace(term, r"\(III\)", "3+"), r"\(II\)", "2+"), r"\(I\)", "1+"),
        "locant": F.regexp_replace(term, r"(\d),(\d)", "$1 $2"),
        "script": F.translate(term, "₀₁₂₃₄₅₆₇₈₉⁰¹²³⁴⁵⁶⁷⁸⁹", "01234567890123456789"),
    }
    # a change of case alone is no other term, so it is left to terms that nothing else changes
    options = F.array(*(F.struct(tx.md5_key(seed, "noise", *key, k).alias("k"), c.alias("x")) for k, c in changes.items() if k != "case"))
    kept = F.filter(options, lambda o: o["x"].isNotNull() & (F.lower(o["x"]) != F.lower(term)))
    return F.coalesce(F.array_min(kept)["x"], changes["case"])


def provide_terms(picked: DataFrame, aliases: DataFrame, lexicon: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The default provider: the parallel row's surface, else the graph's first alias; noise; the lexicon.

    aliases: (chebi_id, lang, pos, alias); lexicon: (lang, word, swap_lang, term).
    """
    first = aliases.groupBy(F.col("chebi_id"), F.col("lang").alias("swap_lang")).agg(F.min_by("alias", F.struct("pos", "alias")).alias("__alias"))
    words = lexicon.groupBy(F.col("lang").alias("language"), F.col("word").alias("__word"), "swap_lang").agg(F.min("term").alias("__term"))
    x = picked.join(first, ["chebi_id", "swap_lang"], "left").withColumn("__word", F.lower("original_term")).join(words, ["language", "__word", "swap_lang"], "left")
    own = F.get(F.filter("parallel", lambda m: m["chebi_id"] == F.col("chebi_id")), F.lit(0))["surface"]
    noise = noisy(F.col("original_term"), cfg.seed, F.col("id"))
    term = F.when(F.col("variant") == "B_in_set", F.coalesce(own, "__alias")).when(F.col("variant") == "C_out_of_set", F.col("__alias")).when(F.col("variant") == "D_noisy", noise).otherwise(F.col("__term"))
    return x.withColumn("swap_term", term).drop("__alias", "__word", "__term")


Hook = Callable[[DataFrame], DataFrame]


def verify(filled: DataFrame, aliases: DataFrame, judge: Hook | None = None, back: Hook | None = None) -> DataFrame:
    """filled with the spliced text, its offset, the round-trip flag and the first check that fails.

    judge adds ``meaning_kept`` and back ``comes_back`` to cells (providers.judge_by_model and
    back_by_model do, bound to a provider). Without them, the text outside the splice is the
    source's, which stands for the preserved meaning, and the round trip asks whether the
    swapped term names the same concept in the source language.
    """
    text = tx.splice(F.col("text"), F.col("swap_start"), F.col("swap_end"), F.col("swap_term"))
    x = filled.withColumn("rewrite", F.when(F.col("original_term").isNotNull() & F.col("swap_term").isNotNull(), text))
    x = x.withColumn("swap_char_offset", tx.term_presence_offset(F.col("rewrite"), F.col("swap_term")))
    names = aliases.groupBy(F.col("chebi_id"), F.col("lang").alias("language")).agg(F.collect_set(F.lower("alias")).alias("__back"))
    x = x.join(names, ["chebi_id", "language"], "left")
    same = F.coalesce(F.array_contains("__back", F.lower("original_term")), F.lit(False))
    reason = (
        F.when(F.col("original_term").isNull(), "no_mention")
        .when(F.col("swap_term").isNull(), "no_term")
        .when(~tx.is_usable_swap(F.col("swap_term")), "swap_term_unusable")
        .when(F.lower("swap_term") == F.lower("original_term"), "swap_equals_original")
        .when(F.col("swap_char_offset").isNull(), "term_presence")
    )
    x = x.withColumns({"reject_reason": reason, "__same": same}).drop("__back")
    open_ = F.col("reject_reason").isNull()
    if judge:
        asked = judge(x.withColumn("rewrite", F.when(open_, F.col("rewrite"))))  # nothing is asked about what has failed
        x = asked.withColumn("reject_reason", F.coalesce("reject_reason", F.when(~F.coalesce("meaning_kept", F.lit(False)), "semantic_preservation"))).drop("meaning_kept")
    if back:
        x = back(x.withColumn("rewrite", F.when(open_, F.col("rewrite")))).withColumn("__same", F.coalesce("comes_back", F.lit(False))).drop("comes_back")
    flag = F.when(F.col("variant").isin("B_in_set", "C_out_of_set"), ~F.col("__same"))
    return x.withColumn("round_trip_flag", flag).drop("__same")


def checked_cells(rows: DataFrame, linked: DataFrame, freq: DataFrame, aliases: DataFrame, lexicon: DataFrame, cfg: Config = Config(), provide: Hook | None = None, judge: Hook | None = None, back: Hook | None = None, abbreviations: DataFrame | None = None, nouns: DataFrame | None = None) -> DataFrame:
    """All cells of the source rows (with fields and l_avail), provided and verified; for abbreviations see with_positions, for nouns pick_words.

    provide fills ``swap_term`` of the picked cells; without it, provide_terms does. For judge and back see verify.
    """
    grid = cells(with_positions(rows, abbreviations), cfg)
    picked = pick_mentions(grid, freq, parallel_rows(linked, rows), cfg)
    words = pick_words(grid, cfg, nouns).withColumns({"parallel": F.lit(None).cast(picked.schema["parallel"].dataType), "parallel_text": F.lit(None).cast("string")})
    both = picked.unionByName(words)
    return verify(provide(both) if provide else provide_terms(both, aliases, lexicon, cfg), aliases, judge, back)


def clean_records(rows: DataFrame) -> DataFrame:
    """Variant A: the source as it is."""
    fixed = {"variant_tag": F.lit("A_clean"), "position": F.lit("na"), "fallback_flag": F.lit(False)}
    none = {c: F.lit(None) for c in ("swap_lang", "original_term", "swap_term", "swap_char_offset", "chebi_id", "control_style", "round_trip_flag")}
    x = rows.select("id", "publication_number", F.col("l_avail").alias("available_languages"), F.col("language").alias("source_language"), "text")
    return _record(x.withColumns(fixed | none))


def swap_records(checked: DataFrame) -> DataFrame:
    """Variants B to E: the accepted cells."""
    x = checked.where("reject_reason is null").drop("text")
    return _record(x.withColumnsRenamed({"l_avail": "available_languages", "language": "source_language", "variant": "variant_tag", "rewrite": "text"}))


def _record(x: DataFrame) -> DataFrame:
    from pyspark.sql.types import StructType

    x = x.withColumns({"instance_id": tx.record_id(F.col("id"), F.col("variant_tag"), F.col("position")), "source_row_id": F.col("id")})
    return x.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(VARIANT)))


def variants(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """All records: at most nine for a source row."""
    return clean_records(rows).unionByName(swap_records(checked))


def outcome_counts(checked: DataFrame) -> DataFrame:
    """(variant, position, outcome, n): accepted, skipped (nothing to exchange) or the check that failed."""
    outcome = F.coalesce("reject_reason", F.lit("accepted"))
    return checked.groupBy("variant", "position", outcome.alias("outcome")).agg(F.count("*").alias("n"))
