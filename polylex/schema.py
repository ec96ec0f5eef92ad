"""Languages, settings and explicit schemas of every artifact."""

from __future__ import annotations

from dataclasses import dataclass

# The languages of the corpus, in the order of all per-language structs.
LANGS = ("en", "de", "es", "fr", "zh")
# The fields whose newline join is a document's text, in this order.
TEXT_FIELDS = ("title", "abstract", "description", "first_claim", "context")
# Neighbor relations in order of priority, as the graph artifact names them.
RELATIONS = ("siblings_isa", "siblings_role", "conjugate_pair", "tautomers", "stereo_or_tautomer_inchikey_block", "parent_hydride_family")
# The positions a variant may change.
POSITIONS = ("title", "first_sentence", "body")


@dataclass(frozen=True)
class Config:
    """Settings with their usual values."""

    seed: int = 42
    bench1_target: int = 80
    bench2_target: int = 80
    max_negatives: int = 10
    min_alias_len: int = 3
    min_alias_len_zh: int = 2
    min_tokens: int = 200
    freq_floor: int = 3
    #: The index of a dictionary is sorted and packed in parts of about so many keys.
    keys_in_part: int = 1 << 20
    #: Keys start and end between a text's characters only, also where folding makes one longer: "sach" is not found in "ßach".
    whole_characters: bool = False
    #: Keep memberships in groups beside the graph instead of lists of neighbors in it, for roles of very many concepts.
    memberships: bool = False


CORPUS = "id string, language string, " + ", ".join(f"{f} string" for f in TEXT_FIELDS) + ", publication_number string"
MENTION = "struct<surface:string,start:int,end:int,chebi_id:string>"
LINKED = f"id string, publication_number string, language string, text string, mentions array<{MENTION}>, primary_chebi_id string"
_LISTS = "struct<" + ",".join(f"{x}:array<string>" for x in LANGS) + ">"
CONCEPTS = (
    "chebi_id string, chebi_name_en string, inchikey string, inchi string, smiles string, formula string, chebi_star int, "
    f"aliases_chebi {_LISTS}, wikidata_qid string, wikipedia_titles struct<{','.join(f'{x}:string' for x in LANGS)}>, aliases_combined {_LISTS}, "
    "parents_isa array<string>, roles array<string>, " + ", ".join(f"{r} array<string>" for r in RELATIONS)
)
VARIANT = (
    "instance_id string, source_row_id string, publication_number string, available_languages array<string>, source_language string, "
    "variant_tag string, position string, text string, swap_lang string, original_term string, swap_term string, swap_char_offset int, "
    "chebi_id string, control_style string, round_trip_flag boolean, fallback_flag boolean"
)
CACHE = "key string, request struct<model:string,system:string,user:string,temperature:double,max_output_tokens:int>, response string"
