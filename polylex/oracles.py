"""The queries of catalog.py as DuckDB statements over the driver's tables."""

from __future__ import annotations

import re

from . import fixtures as fx
from .functions.text import ROLE_BUCKETS
from .operators import nouns as nw
from .operators import sentences as sn
from .operators.providers import RULES
from .schema import RELATIONS, Config

_CFG = Config()
_S = _CFG.seed


def _duck(table: tuple) -> str:
    return _here(fx.values(table))


def _here(sql: str) -> str:
    return sql.replace("AS STRING", "AS VARCHAR").replace("{part}", "part").replace("{words}", "words")


_NORM = "CASE WHEN trim({0}) LIKE 'CHEBI:%' THEN trim({0}) WHEN regexp_matches(trim({0}), '^-*[0-9]+$') THEN concat('CHEBI:', trim({0})) END"
_OBO = ", ".join("(" + " || chr(10) || ".join("'" + y + "'" for y in x.split("\n")) + ")" for x in fx.OBO)


def _fold(c: str) -> str:
    """Full case folding of what the corpus has."""
    return f"replace(lower({c}), 'ß', 'ss')"


def _n(c: str) -> str:
    return _NORM.format(c)


_NEAR = {
    "siblings_isa": "SELECT DISTINCT a.src AS chebi_id, b.src AS neighbor FROM edges a JOIN edges b ON a.dst = b.dst AND a.src <> b.src WHERE a.rel = 'is_a' AND b.rel = 'is_a'",
    "siblings_role": "SELECT DISTINCT a.src AS chebi_id, b.src AS neighbor FROM edges a JOIN edges b ON a.dst = b.dst AND a.src <> b.src WHERE a.rel = 'has_role' AND b.rel = 'has_role'",
    "conjugate_pair": "SELECT DISTINCT src AS chebi_id, dst AS neighbor FROM edges WHERE rel IN ('is_conjugate_acid_of', 'is_conjugate_base_of') AND src <> dst",
    "tautomers": "SELECT DISTINCT src AS chebi_id, dst AS neighbor FROM edges WHERE rel = 'is_tautomer_of' AND src <> dst",
    "stereo_or_tautomer_inchikey_block": "SELECT DISTINCT a.chebi_id, b.chebi_id AS neighbor FROM nodes a JOIN nodes b ON left(a.inchikey, 14) = left(b.inchikey, 14) AND a.chebi_id <> b.chebi_id WHERE length(a.inchikey) >= 14 AND length(b.inchikey) >= 14",
    "parent_hydride_family": "SELECT DISTINCT a.src AS chebi_id, b.src AS neighbor FROM edges a JOIN edges b ON a.dst = b.dst AND a.src <> b.src WHERE a.rel = 'has_parent_hydride' AND b.rel = 'has_parent_hydride'",
}

def _ends(table: str) -> str:
    """(id, fe): where the first sentence of each text of a step (id, language, text) ends."""
    closers = sn.CLOSERS.replace("'", "''").replace("]", r"\]")
    marks = f"[{sn.MARKS}{sn.WIDE}]+[{closers}]*"
    return rf"""SELECT t.id, coalesce(min(CASE WHEN m = chr(10) THEN e - 1 ELSE e END) FILTER (WHERE CASE
            WHEN m = chr(10) THEN regexp_matches(substring(t.text, 1, (e - 1)::INT), '\S') WHEN m IS NULL OR m = '' THEN false WHEN regexp_matches(m, '[{sn.WIDE}]') THEN true
            WHEN e < length(t.text) AND NOT regexp_matches(substring(t.text, e::INT + 1, 1), '\s') THEN false
            WHEN regexp_matches(ltrim(substring(t.text, e::INT + 1, 64), e' \n\t\r'), '^\p{{Ll}}') THEN false
            WHEN m LIKE '.%' AND m NOT LIKE '..%' AND (regexp_matches(w, '^\p{{Lu}}$') OR (t.language, lower(w)) IN (SELECT (lang, word) FROM abbr)) THEN false ELSE true END), max(length(t.text))) AS fe
        FROM {table} t LEFT JOIN (SELECT id, m, e, regexp_extract(substring(text, greatest(1, e - length(m) - 63)::INT, least(64, e - length(m))::INT), '\p{{L}}+(?:\.\p{{L}}+)*$') AS w FROM (
            SELECT id, text, regexp_extract(c, '(?:{marks}|\n)$') AS m, sum(length(c)) OVER (PARTITION BY id ORDER BY i) AS e FROM (
            SELECT id, text, unnest(p) AS c, generate_subscripts(p, 1) AS i FROM (SELECT id, text, regexp_extract_all(text, '[^{sn.MARKS}{sn.WIDE}\n]*(?:{marks}|\n|$)') AS p FROM {table})))) c ON c.id = t.id GROUP BY t.id"""


_LED = " OR ".join(f"lang = '{lang}' AND a IN ({', '.join(repr(w) for w in ws)})" for lang, ws in nw.DETERMINERS.items())

#: Named steps; each statement takes those that it needs, in this order.
STEPS = {
    "corpus": "SELECT concat_ws('_', (doc_id // 4)::VARCHAR, lang, doc_id::VARCHAR) AS id, lang AS language, (doc_id // 4)::VARCHAR AS publication_number, a[1] AS title, coalesce(a[2], '') AS abstract, coalesce(array_to_string(a[3:], chr(10)), '') AS description FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)",
    "docs": "SELECT id, publication_number, language, concat_ws(chr(10), title, abstract, description, '', '') AS text FROM corpus",
    "l_avail": "SELECT publication_number, list_sort(list(DISTINCT language)) AS l_avail FROM corpus GROUP BY publication_number",
    "words": f"SELECT lang, word, h FROM (SELECT DISTINCT lang, word, ('0x' || substr(md5(word), 1, 13))::BIGINT AS h FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '{fx.WORD}')) AS word FROM documents)) WHERE CAST(floor(h / 7) AS BIGINT) % 4 = 0",
    "terms": f"SELECT {_n('id')} AS id, name, parents FROM (SELECT regexp_extract(v, '(?m)^id: (\\S+)', 1) AS id, nullif(regexp_extract(v, '(?m)^name: (.*)$', 1), '') AS name, regexp_extract_all(v, '(?m)^is_a: (CHEBI:[0-9]+)', 1) AS parents, regexp_matches(v, '(?m)^is_obsolete: true') AS gone FROM (SELECT split_part(value, chr(10) || '[Typedef]', 1) AS v FROM (SELECT * FROM (VALUES {_OBO}) AS t(value) UNION ALL {_here(fx.STANZAS)}))) WHERE NOT gone AND {_n('id')} IS NOT NULL",
    "compounds": f"SELECT chebi_id, last(name ORDER BY pos) FILTER (WHERE name <> '' AND name <> 'null') AS name, last(try_cast(trim(stars) AS INT) ORDER BY pos) FILTER (WHERE regexp_matches(trim(stars), '^[0-9]+$')) AS star, arg_max(parent_id, pos) AS parent_id FROM (SELECT {_n('coalesce(nullif(chebi_accession, $$$$), id)')} AS chebi_id, name, stars, coalesce({_n('parent_id')}, '-') AS parent_id, pos FROM {_duck(fx.COMPOUNDS)}) WHERE chebi_id IS NOT NULL GROUP BY chebi_id".replace("$$$$", "''"),
    "structs": f"""SELECT chebi_id, last(inchi ORDER BY pos) FILTER (WHERE inchi IS NOT NULL) AS inchi, last(inchikey ORDER BY pos) FILTER (WHERE inchikey IS NOT NULL) AS inchikey, last(smiles ORDER BY pos) FILTER (WHERE smiles IS NOT NULL) AS smiles FROM (
        SELECT *, min(pos) FILTER (WHERE inchi IS NOT NULL) OVER (PARTITION BY chebi_id) AS known FROM (SELECT {_n("compound_id")} AS chebi_id, pos, coalesce(upper(trim(default_structure)) IN ('T', 'TRUE', '1'), false) AS d, nullif(trim(standard_inchi), '') AS inchi, nullif(trim(standard_inchi_key), '') AS inchikey, nullif(trim(smiles), '') AS smiles FROM {_duck(fx.STRUCTURES)}))
        WHERE d OR known IS NULL OR pos <= known GROUP BY chebi_id""",
    "formulas": f"SELECT chebi_id, arg_min(formula, pos) AS formula FROM (SELECT {_n('compound_id')} AS chebi_id, nullif(trim(formula), '') AS formula, pos FROM {_duck(fx.FORMULAS)}) WHERE formula IS NOT NULL GROUP BY chebi_id",
    "nodes": "SELECT chebi_id, coalesce(c.name, t.name) AS name, c.star, c.parent_id, s.inchi, s.inchikey, s.smiles, f.formula FROM (SELECT id AS chebi_id, name FROM terms) t FULL JOIN compounds c USING (chebi_id) FULL JOIN structs s USING (chebi_id) FULL JOIN formulas f USING (chebi_id)",
    "relations": f"SELECT {_n('init_id')} AS src, code AS rel, {_n('final_id')} AS dst, r.pos FROM {_duck(fx.RELATIONS)} r JOIN {_duck(fx.RELATION_TYPES)} t ON trim(r.relation_type_id) = trim(t.id) WHERE code IN ('has_role', 'has_parent_hydride', 'is_conjugate_acid_of', 'is_conjugate_base_of', 'is_tautomer_of') AND (status_id IS NULL OR NOT regexp_matches(trim(status_id), '^[0-9]+$') OR trim(status_id) IN ('1', '3')) AND {_n('init_id')} IS NOT NULL AND {_n('final_id')} IS NOT NULL",
    "edges": "SELECT id AS src, 'is_a' AS rel, unnest(parents) AS dst, generate_subscripts(parents, 1)::BIGINT AS pos FROM terms UNION ALL SELECT src, rel, dst, pos FROM relations",
    "names": f"SELECT chebi_id, lang, pos, place, alias FROM (SELECT *, row_number() OVER (PARTITION BY chebi_id, lang, {_fold('alias')} ORDER BY pos) AS n FROM (SELECT {_n('compound_id')} AS chebi_id, coalesce(nullif(lower(trim(language_code)), ''), 'en') AS lang, pos, row_number() OVER (ORDER BY pos, language_code, name) - 1 AS place, name AS alias FROM {_duck(fx.NAMES)}) WHERE chebi_id IS NOT NULL AND lang IN ('en', 'de', 'es', 'fr', 'zh') AND alias <> 'null' AND alias <> '') WHERE n = 1",
    "titles": f"SELECT chebi_id, qid, lang, title FROM {_duck(fx.TITLES)}",
    "combined": f"SELECT chebi_id, lang, pos, alias FROM (SELECT *, row_number() OVER (PARTITION BY chebi_id, lang, {_fold('alias')} ORDER BY pos) AS n FROM (SELECT chebi_id, lang, pos, alias FROM names UNION ALL SELECT chebi_id, lang, 1::BIGINT << 60, title FROM (SELECT *, row_number() OVER (PARTITION BY chebi_id, lang ORDER BY qid, title) AS k FROM titles) WHERE k = 1)) WHERE n = 1",
    "dict": f"SELECT lang, key, chebi_id, row_number() OVER (PARTITION BY lang, key ORDER BY chebi_id, pos)::INT AS reg_order FROM (SELECT lang, {_fold('alias')} AS key, chebi_id, min(pos) AS pos FROM combined WHERE length(alias) >= CASE lang WHEN 'zh' THEN {_CFG.min_alias_len_zh} ELSE {_CFG.min_alias_len} END GROUP BY ALL)",
    "keys": r"SELECT lang, key, p[1] AS w, len(p) AS np FROM (SELECT DISTINCT lang, key, regexp_extract_all(key, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]') AS p FROM dict)",
    "pieces": r"SELECT id, language, w, replace(lower(w), 'ß', 'ss') AS f, i FROM (SELECT id, language, unnest(p) AS w, generate_subscripts(p, 1) AS i FROM (SELECT id, language, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]') AS p FROM docs))",
    "look": "SELECT id, language, f AS w, (sum(length(w)) OVER o - length(w))::INT AS s, list(f) OVER b AS win, list(length(w)) OVER b AS sizes FROM pieces WINDOW o AS (PARTITION BY id ORDER BY i), b AS (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)",
    "hits": "SELECT x.id, x.s, (x.s + list_sum(list_slice(sizes, 1, np)))::INT AS e, k.lang, k.key FROM look x JOIN keys k ON x.language = k.lang AND x.w = k.w WHERE array_to_string(list_slice(win, 1, np), '') = k.key",
    "far": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, s ORDER BY e DESC) AS n FROM hits) WHERE n = 1",
    "isle": "SELECT *, sum(CASE WHEN reach IS NULL OR s >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY s) AS k FROM (SELECT *, max(e) OVER (PARTITION BY id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM far)",
    "won": "SELECT id, s, e, lang, key FROM (SELECT *, row_number() OVER (PARTITION BY id, k ORDER BY e DESC, s) AS m FROM isle) WHERE m = 1",
    "cand": "SELECT w.*, d.chebi_id, d.reg_order, count(*) OVER (PARTITION BY w.id, w.s) AS c FROM won w JOIN dict d ON w.lang = d.lang AND w.key = d.key",
    "best": "SELECT c.*, row_number() OVER (PARTITION BY c.id, c.s ORDER BY coalesce(u.n, 0) DESC, c.reg_order) AS r FROM cand c LEFT JOIN (SELECT id, chebi_id, count(*) AS n FROM cand WHERE c = 1 GROUP BY ALL) u ON c.id = u.id AND c.chebi_id = u.chebi_id",
    "mentions": "SELECT b.id, t.publication_number, t.language, substring(t.text, b.s + 1, b.e - b.s) AS surface, b.s::INT AS \"start\", b.e::INT AS \"end\", b.chebi_id FROM best b JOIN docs t ON b.id = t.id WHERE r = 1",
    "prim": "SELECT d.id, p.chebi_id AS primary_chebi_id FROM docs d LEFT JOIN (SELECT id, chebi_id FROM (SELECT id, chebi_id, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, min(\"start\")) AS n FROM mentions GROUP BY id, chebi_id) WHERE n = 1) p USING (id)",
    "around": "SELECT id, chebi_id, string_agg(w, chr(10) || '---' || chr(10) ORDER BY \"start\") AS beside FROM (SELECT m.*, substring(t.text, greatest(0, m.\"start\" - 200) + 1, m.\"end\" + 200 - greatest(0, m.\"start\" - 200)) AS w, row_number() OVER (PARTITION BY m.id, m.chebi_id ORDER BY m.\"start\") AS k FROM mentions m JOIN docs t ON m.id = t.id) WHERE k <= 2 GROUP BY id, chebi_id",
    "idx": "SELECT DISTINCT chebi_id, id, language FROM mentions",
    "langs": "SELECT chebi_id, count(DISTINCT language) AS mention_langs FROM idx GROUP BY chebi_id",
    "freq": "SELECT chebi_id, count(*) AS freq FROM mentions GROUP BY chebi_id",
    "near": " UNION ALL ".join(f"SELECT chebi_id, neighbor, '{r}' AS relation, {k + 1} AS prio FROM ({_NEAR[r]})" for k, r in enumerate(RELATIONS)),
    "slice": "SELECT n.*, coalesce(string_agg(e.dst, ',' ORDER BY e.pos) FILTER (WHERE e.rel = 'has_role'), '') AS roles, coalesce(string_agg(e.dst, ',' ORDER BY e.pos) FILTER (WHERE e.rel = 'is_a'), '') AS parents_isa FROM nodes n LEFT JOIN edges e ON n.chebi_id = e.src WHERE n.chebi_id IN (SELECT chebi_id FROM mentions) GROUP BY ALL",
    "coarse": "SELECT chebi_id, star, coalesce((SELECT arg_min(b.bucket, e.pos) FROM edges e JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in ROLE_BUCKETS.items()) + ") AS b(role, bucket) ON e.dst = b.role WHERE e.rel = 'has_role' AND e.src = s.chebi_id), CASE WHEN regexp_matches(formula, '[0-9]') AND length(formula) < 30 THEN 'small_molecule' ELSE 'other' END) AS coarse FROM slice s",
    "qual": "SELECT c.chebi_id, c.star, a.n AS alias_lang_count, l.mention_langs AS mention_lang_count, x.n AS neighbor_count_in_corpus, c.coarse FROM coarse c JOIN (SELECT chebi_id, count(DISTINCT lang)::INT AS n FROM combined GROUP BY chebi_id) a USING (chebi_id) JOIN langs l USING (chebi_id) JOIN (SELECT chebi_id, count(DISTINCT neighbor) AS n FROM near WHERE neighbor IN (SELECT chebi_id FROM langs) GROUP BY chebi_id) x USING (chebi_id) WHERE c.star IN (2, 3) AND a.n >= 3 AND l.mention_langs >= 2",
    "gold": f"SELECT chebi_id, language AS gold_language, id AS gold_id FROM (SELECT i.*, row_number() OVER (PARTITION BY i.chebi_id ORDER BY md5(concat_ws('|', '{_S}', 'gold_doc', i.chebi_id, i.id)), i.id) AS n FROM idx i JOIN (SELECT chebi_id, arg_min(language, md5(concat_ws('|', '{_S}', 'gold_lang', chebi_id, language))) AS language FROM (SELECT DISTINCT chebi_id, language FROM idx) GROUP BY chebi_id) l USING (chebi_id, language)) WHERE n = 1",
    "pool": f"SELECT * FROM (SELECT g.chebi_id, n.neighbor, n.relation, i.id, i.language, row_number() OVER (PARTITION BY g.chebi_id, n.neighbor, i.language ORDER BY md5(concat_ws('|', '{_S}', 'neg', g.chebi_id, n.neighbor, i.id)), i.id)::INT AS turn FROM gold g JOIN (SELECT chebi_id, neighbor, arg_min(relation, prio) AS relation FROM near GROUP BY ALL) n ON g.chebi_id = n.chebi_id AND n.neighbor <> g.chebi_id JOIN idx i ON i.chebi_id = n.neighbor AND i.language <> g.gold_language WHERE NOT EXISTS (SELECT 1 FROM idx j WHERE j.chebi_id = g.chebi_id AND j.id = i.id))",
    "queue": f"SELECT chebi_id, list(struct_pack(n := neighbor, l := language, d := id, r := relation) ORDER BY md5(concat_ws('|', '{_S}', 'neg', chebi_id, neighbor, id)), neighbor, id) AS q FROM pool GROUP BY chebi_id",
    "picks": f"""SELECT chebi_id, q, list_filter(q, lambda x: false) AS got FROM queue UNION ALL SELECT chebi_id, list_filter(s[2:], lambda x: x.d <> s[1].d), list_append(got, s[1]) FROM (
        SELECT chebi_id, got, list_transform(list_sort(list_transform(q, lambda x, i: struct_pack(p := CASE WHEN list_contains(ns, x.n) THEN 2 ELSE 0 END + CASE WHEN list_contains(ls, x.l) THEN 1 ELSE 0 END, i := i, x := x))), lambda y: y.x) AS s FROM (
        SELECT *, list_transform(got, lambda c: c.n) AS ns, list_transform(got, lambda c: c.l) AS ls FROM picks WHERE len(q) > 0 AND len(got) < {_CFG.max_negatives}))""",
    "negs": "SELECT chebi_id, k::INT AS rank, got[k].n AS neighbor, got[k].r AS relation, got[k].d AS id, got[k].l AS language FROM (SELECT chebi_id, got, unnest(range(1, len(got) + 1)) AS k FROM (SELECT chebi_id, arg_max(got, len(got)) AS got FROM picks GROUP BY chebi_id))",
    "nearby": "SELECT u.chebi_id, u.neighbor, u.relation, s.name AS chebi_name_en FROM (SELECT chebi_id, neighbor, min(relation) AS relation FROM negs GROUP BY ALL) u JOIN slice s ON s.chebi_id = u.neighbor",
    "chosen": f"SELECT * FROM qual ORDER BY star DESC, row_number() OVER (PARTITION BY star, coarse, alias_lang_count ORDER BY md5(concat_ws('|', '{_S}', 'sample', chebi_id)), chebi_id), md5(concat_ws('|', '{_S}', 'stratum', coarse, alias_lang_count)), chebi_id LIMIT {_CFG.bench1_target}",
    "made": "SELECT g.chebi_id, g.gold_language, g.gold_id FROM chosen c JOIN slice s USING (chebi_id) JOIN gold g USING (chebi_id) WHERE c.chebi_id IN (SELECT chebi_id FROM negs)",
    "srcrows": rf"SELECT d.id, d.publication_number, d.language, d.text, l.l_avail, len(list_filter(regexp_split_to_array(d.text, '\s+'), lambda x: x <> '')) AS tokens FROM docs d JOIN l_avail l USING (publication_number) WHERE d.id IN (SELECT id FROM mentions) AND len(list_filter(regexp_split_to_array(d.text, '\s+'), lambda x: x <> '')) >= {_CFG.min_tokens}",
    "sample": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY publication_number ORDER BY md5(concat_ws('|', '{_S}', 'row', id)), id) AS n FROM srcrows) WHERE n = 1 ORDER BY CASE WHEN len(l_avail) IN (2, 3) THEN 0 ELSE 1 END, md5(concat_ws('|', '{_S}', 'pub', publication_number)), publication_number LIMIT {_CFG.bench2_target}",
    "marked": rf"""SELECT id, language, regexp_replace(regexp_replace(regexp_replace(text, '{sn.INNER}', '\1' || chr(2) || '\2', 'g'), '{sn.INNER}', '\1' || chr(2) || '\2', 'g'), '{sn.ON}', '\1' || chr(1) || '\2', 'g') AS text FROM docs""",
    "abbr": rf"""SELECT lang, word FROM (SELECT language AS lang, replace(lower(regexp_replace(t, '[.\x01]$', '')), chr(2), '.') AS word, count(*) AS n, count(*) FILTER (WHERE regexp_matches(t, '[.\x01]$')) AS dots, count(*) FILTER (WHERE regexp_matches(t, '\x01$')) AS goes_on
        FROM (SELECT language, unnest(regexp_extract_all(text, '[\p{{L}}\x02]+[.\x01]?')) AS t FROM marked) GROUP BY ALL) WHERE word <> '' AND dots >= {sn.LEAST} AND 100 * dots >= {sn.SHARE} * n AND 2 * goes_on >= dots""",
    "docends": _ends("docs"),
    "leads": r"SELECT id, language, CASE WHEN trim(abstract, e' \n\t\r') <> '' THEN abstract ELSE description END AS text FROM corpus",
    "leadends": _ends("leads"),
    "posn": r"""SELECT id, CASE WHEN trim(title, e' \n\t\r') <> '' THEN 0 END AS t0, CASE WHEN trim(title, e' \n\t\r') <> '' THEN length(title) END AS t1, f0, f1,
        CASE WHEN f0 IS NOT NULL AND f0 >= d0 AND f0 < d1 THEN f1 ELSE d0 END AS b0, d1 AS b1 FROM (
        SELECT *, CASE WHEN a_ok THEN a0 WHEN d_ok THEN d0 END AS f0, CASE WHEN a_ok THEN a0 + fe WHEN d_ok THEN d0 + fe END AS f1 FROM (
        SELECT *, length(title) + 1 AS a0, length(title) + length(abstract) + 2 AS d0, length(title) + length(abstract) + 2 + length(description) AS d1, trim(abstract, e' \n\t\r') <> '' AS a_ok, trim(description, e' \n\t\r') <> '' AS d_ok FROM corpus JOIN leadends USING (id)))""",
    "placed": "SELECT m.*, CASE WHEN m.\"start\" >= t0 AND m.\"start\" < t1 THEN 'title' WHEN m.\"start\" >= f0 AND m.\"start\" < f1 THEN 'first_sentence' WHEN b1 > b0 AND m.\"start\" >= b0 AND m.\"start\" < b1 THEN 'body' END AS position FROM mentions m JOIN posn p USING (id)",
    "grid": f"""SELECT *, CASE variant WHEN 'B_in_set' THEN ins WHEN 'C_out_of_set' THEN outs WHEN 'D_noisy' THEN language ELSE CASE control_style WHEN 'in_set' THEN ins ELSE outs END END AS swap_lang FROM (
        SELECT *, CASE WHEN variant = 'E_control_nonchem' THEN CASE WHEN ins IS NULL THEN 'out_of_set' WHEN outs IS NULL THEN 'in_set' WHEN md5(concat_ws('|', '{_S}', 'style', id, 'in_set')) < md5(concat_ws('|', '{_S}', 'style', id, 'out_of_set')) THEN 'in_set' ELSE 'out_of_set' END END AS control_style FROM (
        SELECT s.*, c.variant, c.position, (SELECT arg_min(x, md5(concat_ws('|', '{_S}', 'lang', s.id, c.variant, c.position, x))) FROM (SELECT unnest(s.l_avail) AS x) WHERE x <> s.language) AS ins,
        (SELECT arg_min(x, md5(concat_ws('|', '{_S}', 'lang', s.id, c.variant, c.position, x))) FROM (SELECT unnest(['en', 'de', 'es', 'fr', 'zh']) AS x) WHERE NOT list_contains(s.l_avail, x)) AS outs
        FROM sample s, (VALUES ('B_in_set', 'title'), ('B_in_set', 'first_sentence'), ('B_in_set', 'body'), ('C_out_of_set', 'title'), ('C_out_of_set', 'first_sentence'), ('C_out_of_set', 'body'), ('D_noisy', 'body'), ('E_control_nonchem', 'body')) AS c(variant, position))) WHERE swap_lang IS NOT NULL""",
    "par": "SELECT publication_number, language AS swap_lang, id AS pid FROM (SELECT *, row_number() OVER (PARTITION BY publication_number, language ORDER BY id) AS n FROM docs) WHERE n = 1",
    "picked": f"""SELECT * FROM (SELECT g.id, g.publication_number, g.l_avail, g.language, g.text, g.variant, g.position, g.swap_lang, g.control_style, p.pid, m.surface AS original_term, m."start" AS s, m."end" AS e, m.chebi_id, m.tier > 0 AS fallback_flag,
        row_number() OVER (PARTITION BY g.id, g.variant, g.position ORDER BY m.tier, md5(concat_ws('|', '{_S}', 'pick', g.id, g.variant, g.position, m."start"))) AS n FROM grid g LEFT JOIN par p USING (publication_number, swap_lang) LEFT JOIN (
        SELECT a.id, g.variant, g.position, a.surface, a."start", a."end", a.chebi_id, CASE WHEN ok AND f.freq >= {_CFG.freq_floor} THEN 0 WHEN ok THEN 1 ELSE 2 END AS tier FROM (
            SELECT g.id, g.variant, g.position, a.surface, a."start", a."end", a.chebi_id, g.variant <> 'B_in_set' OR EXISTS (SELECT 1 FROM par p JOIN idx i ON i.id = p.pid WHERE p.publication_number = g.publication_number AND p.swap_lang = g.swap_lang AND i.chebi_id = a.chebi_id) AS ok
            FROM grid g JOIN placed a ON a.id = g.id AND a.position = g.position WHERE g.variant <> 'E_control_nonchem') a JOIN freq f ON f.chebi_id = a.chebi_id JOIN grid g ON g.id = a.id AND g.variant = a.variant AND g.position = a.position) m
        ON m.id = g.id AND m.variant = g.variant AND m.position = g.position WHERE g.variant <> 'E_control_nonchem') WHERE n = 1""",
    "firstalias": "SELECT chebi_id, lang, arg_min(alias, pos) AS alias FROM combined GROUP BY ALL",
    "bc": """SELECT p.*, CASE WHEN variant = 'B_in_set' THEN coalesce((SELECT arg_min(q.surface, q."start") FROM mentions q WHERE q.id = p.pid AND q.chebi_id = p.chebi_id), a.alias) ELSE a.alias END AS swap_term FROM picked p LEFT JOIN firstalias a ON a.chebi_id = p.chebi_id AND a.lang = p.swap_lang WHERE variant IN ('B_in_set', 'C_out_of_set')""",
    "noise": f"""SELECT *, (SELECT arg_min(x, k) FROM (SELECT unnest([md5(concat_ws('|', '{_S}', 'noise', id, 'hyphen')), md5(concat_ws('|', '{_S}', 'noise', id, 'vowel')), md5(concat_ws('|', '{_S}', 'noise', id, 'adjacent'))]) AS k,
        unnest([left(original_term, h) || '-' || substring(original_term, h + 1), CASE WHEN regexp_matches(original_term, '(?i)[aeiou]') THEN v || substring(original_term, length(v) + 2) END, left(original_term, h - 1) || substring(original_term, h + 1, 1) || substring(original_term, h, 1) || substring(original_term, h + 2)]) AS x)
        WHERE x IS NOT NULL AND lower(x) <> lower(original_term)) AS swap_term FROM (SELECT *, length(original_term) // 2 AS h, regexp_extract(original_term, '(?i)^([^aeiou]*)([aeiou])', 1) AS v FROM picked WHERE variant = 'D_noisy')""",
    "toks": r"SELECT id, w, e - length(w) AS s, e FROM (SELECT id, w, sum(length(w)) OVER (PARTITION BY id ORDER BY i) AS e FROM (SELECT id, unnest(p) AS w, generate_subscripts(p, 1) AS i FROM (SELECT id, regexp_extract_all(text, '[\p{L}]+|[^\p{L}]+') AS p FROM sample))) WHERE regexp_matches(w, '^\p{L}{4,}$')",
    "nounwords": rf"SELECT lang, word FROM (SELECT lang, word, count(*) AS n, count(*) FILTER (WHERE {_LED}) AS after FROM (SELECT lang, p[1] AS a, p[2] AS word FROM (SELECT language AS lang, unnest(list_zip(w[1:len(w) - 1], w[2:])) AS p FROM (SELECT language, list_transform(regexp_extract_all(text, '\p{{L}}+'), lambda x: lower(x)) AS w FROM docs) WHERE len(w) > 1)) WHERE length(word) >= {nw.LETTERS} GROUP BY lang, word) WHERE after >= {nw.LEAST} AND 100 * after >= {nw.SHARE} * n",
    "noun": f"SELECT id, arg_min(struct_pack(w := w, s := s, e := e), md5(concat_ws('|', '{_S}', 'noun', id, s))) AS t FROM toks k JOIN posn p USING (id) JOIN docs l USING (id) JOIN nounwords x ON x.lang = l.language AND x.word = lower(k.w) WHERE b1 > b0 AND s >= b0 AND e <= b1 AND NOT EXISTS (SELECT 1 FROM mentions m WHERE m.id = k.id AND k.s < m.\"end\" AND k.e > m.\"start\") GROUP BY id",
    "nouns": "SELECT g.id, g.publication_number, g.l_avail, g.language, g.text, g.variant, g.position, g.swap_lang, t.w AS original_term, t.s::INT AS s, t.e::INT AS e, NULL::VARCHAR AS chebi_id, false AS fallback_flag, reverse(lower(t.w)) || g.swap_lang AS swap_term FROM grid g LEFT JOIN noun USING (id) WHERE variant = 'E_control_nonchem'",
    "allc": "SELECT id, l_avail, language, text, variant, position, swap_lang, original_term, s, e, chebi_id, fallback_flag, swap_term FROM bc UNION ALL SELECT id, l_avail, language, text, variant, position, swap_lang, original_term, s, e, chebi_id, fallback_flag, swap_term FROM noise UNION ALL SELECT id, l_avail, language, text, variant, position, swap_lang, original_term, s, e, chebi_id, fallback_flag, swap_term FROM nouns",
    "bcv": r"""SELECT *, CASE WHEN original_term IS NULL THEN 'no_mention' WHEN swap_term IS NULL THEN 'no_term' WHEN length(trim(swap_term)) < 3 THEN 'swap_term_unusable' WHEN lower(swap_term) = lower(original_term) THEN 'swap_equals_original'
        WHEN (length(lower(rewrite)) - length(replace(lower(rewrite), lower(swap_term), ''))) / length(swap_term) <> 1 THEN 'term_presence' END AS reject_reason, (instr(lower(rewrite), lower(swap_term)) - 1)::INT AS o,
        CASE WHEN variant IN ('B_in_set', 'C_out_of_set') THEN NOT EXISTS (SELECT 1 FROM combined c WHERE c.chebi_id = b.chebi_id AND c.lang = b.language AND lower(c.alias) = lower(b.original_term)) END AS round_trip_flag
        FROM (SELECT *, substring(text, 1, s) || swap_term || substring(text, e + 1) AS rewrite FROM allc) b""",
}

#: The linker's steps, once more for the dictionary without titles.
_LINKER = ("dict", "keys", "hits", "far", "isle", "won", "cand", "best", "mentions")
STEPS |= {f"{n}0": re.sub(rf"\b(FROM|JOIN) ({'|'.join(_LINKER)})\b", r"\1 \g<2>0", STEPS[n]).replace("FROM combined", "FROM names") for n in _LINKER}

#: Cells as a model fills and checks them: the term backwards; meaning is kept where its letters are odd in number; it comes back where they are one more than a multiple of four.
STEPS["modelled"] = "SELECT id, language, text, variant, position, s, e, original_term, reverse(original_term) AS swap_term FROM picked UNION ALL SELECT id, language, text, variant, position, s, e, original_term, reverse(original_term) FROM nouns"
STEPS["judged"] = r"""SELECT *, CASE WHEN original_term IS NULL THEN 'no_mention' WHEN length(trim(swap_term)) < 3 THEN 'swap_term_unusable' WHEN lower(swap_term) = lower(original_term) THEN 'swap_equals_original'
        WHEN (length(lower(rewrite)) - length(replace(lower(rewrite), lower(swap_term), ''))) / length(swap_term) <> 1 THEN 'term_presence' WHEN length(original_term) % 2 = 0 THEN 'semantic_preservation' END AS reject_reason
        FROM (SELECT *, substring(text, 1, s) || swap_term || substring(text, e + 1) AS rewrite FROM modelled)"""


def _needs(sql: str) -> list[str]:
    return [name for name in STEPS if re.search(rf"\b(FROM|JOIN) {name}\b", sql)]


def _with(select: str) -> str:
    """The statement with the steps that it needs, directly or not."""
    need: set[str] = set()
    todo = _needs(select)
    while todo:
        x = todo.pop()
        if x not in need:
            need.add(x)
            todo += _needs(STEPS[x])
    steps = ",\n".join(f"{n} AS ({STEPS[n]})" for n in STEPS if n in need)
    return f"WITH RECURSIVE {steps}\n{select}" if steps else select


def _tally(rows: str) -> str:
    """A JSON object of counts by k."""
    return f"(SELECT '{{' || coalesce(string_agg('\"' || k || '\":' || n, ',' ORDER BY k), '') || '}}' FROM (SELECT k, count(*) AS n FROM ({rows}) GROUP BY k))"


_REC = "concat_ws('__', id, variant, position) AS instance_id, id AS source_row_id, array_to_string(l_avail, ',') AS available_languages, swap_lang, original_term, swap_term, o AS swap_char_offset, chebi_id, round_trip_flag, fallback_flag, md5(rewrite) AS text_md5"

SELECTS = {
    "corpus_fields": "SELECT c.id, c.publication_number, c.language, md5(title) AS title_md5, md5(d.text) AS text_md5, length(d.text)::INT AS n FROM corpus c JOIN docs d USING (id)",
    "field_spans": "SELECT id, 0 AS title_start, length(title)::INT AS title_end, (length(title) + 1)::INT AS abstract_start, (length(title) + 1 + length(abstract))::INT AS abstract_end, (length(title) + length(abstract) + 2)::INT AS description_start, (length(title) + length(abstract) + length(description) + 4)::INT AS context_end FROM corpus",
    "l_avail": "SELECT publication_number, array_to_string(l_avail, ',') AS langs FROM l_avail",
    "compounds_parsed": "SELECT chebi_id, name, star, nullif(parent_id, '-') AS parent_id FROM compounds",
    "names_parsed": "SELECT chebi_id, lang, pos, alias FROM names",
    "structures_default": "SELECT chebi_id, inchi, inchikey, smiles FROM structs",
    "formulas_parsed": "SELECT chebi_id, formula FROM formulas",
    "relations_parsed": "SELECT src, rel, dst, pos FROM relations",
    "ontology_terms": "SELECT id, name, array_to_string(parents, ',') AS parents FROM terms",
    "merged_nodes": "SELECT chebi_id, name, star, inchi, inchikey, smiles, formula FROM nodes",
    "all_ids": "SELECT id AS chebi_id FROM terms UNION SELECT chebi_id FROM compounds UNION SELECT chebi_id FROM structs UNION SELECT chebi_id FROM formulas UNION SELECT chebi_id FROM names",
    "titles_asked": "SELECT chebi_id, 'Q' || n AS qid, lang, 'Title ' || n || ' ' || lang AS title FROM (SELECT chebi_id, substr(chebi_id, 7) AS n FROM nodes), (VALUES ('en', 1), ('de', 2), ('es', 3), ('fr', 4)) AS l(lang, k) WHERE n::BIGINT % 5 >= k",
    "corpus_csv": "SELECT id, publication_number, language, md5(regexp_replace(text, '\\r\\n?', chr(10), 'g')) AS text_md5 FROM docs",
    "names_file": "SELECT chebi_id, lang, place AS pos, alias FROM names",
    "terms_file": "SELECT id, name, array_to_string(parents, ',') AS parents FROM terms",
    "alias_union": "SELECT chebi_id, lang, alias FROM combined",
    "alias_inversion": "SELECT lang, key, chebi_id, reg_order FROM dict",
    "link_mentions": 'SELECT id, surface, "start", "end", chebi_id FROM mentions',
    "link_mentions_native": 'SELECT id, surface, "start", "end", chebi_id FROM mentions',
    "link_mentions_parts": 'SELECT id, surface, "start", "end", chebi_id FROM mentions',
    "link_folded": r"""SELECT * FROM (WITH w AS (SELECT id, language, w, e - length(w) AS s, e, replace(lower(w), 'ß', 'ss') AS f FROM (SELECT id, language, w, sum(length(w)) OVER (PARTITION BY id ORDER BY i) AS e FROM (SELECT id, language, unnest(p) AS w, generate_subscripts(p, 1) AS i FROM (SELECT id, language, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]') AS p FROM docs)))),
        long AS (SELECT DISTINCT language, f FROM w WHERE contains(w, 'ß') AND length(w) > 3), short AS (SELECT DISTINCT language, left(f, length(f) - 1) AS f FROM w WHERE w LIKE '%ß' AND length(w) > 3)
        SELECT id, w AS surface, s::INT AS "start", e::INT AS "end", CASE WHEN (language, f) IN (SELECT (language, f) FROM long) THEN 'C:ss' ELSE 'C:s' END AS chebi_id FROM w WHERE (language, f) IN (SELECT (language, f) FROM long UNION SELECT (language, f) FROM short))""",
    "folded_text": "SELECT doc_id, md5(replace(lower(nfc_normalize(coalesce(text, ''))), 'ß', 'ss')) AS folded_md5 FROM documents",
    "request_keys": "SELECT item_id, sha256('{\"max_output_tokens\": 60, \"model\": \"m\", \"system\": \"s\", \"temperature\": 0.0, \"user\": ' || to_json(text) || '}') AS key FROM benchmark",
    "primary_concept": "SELECT id, primary_chebi_id FROM prim",
    "snippets": "SELECT p.id, md5(a.beside) AS snippet_md5 FROM prim p JOIN around a ON a.id = p.id AND a.chebi_id = p.primary_chebi_id",
    "neighbor_counts": "SELECT chebi_id, count(DISTINCT neighbor) AS n FROM near WHERE chebi_id IN (SELECT chebi_id FROM mentions) AND neighbor IN (SELECT chebi_id FROM mentions) GROUP BY chebi_id",
    "linked_file": 'SELECT id, surface, "start", "end", chebi_id FROM mentions',
    "mentioned_ids": "SELECT DISTINCT chebi_id FROM mentions",
    "link_counts": "SELECT (SELECT count(*) FROM docs) AS documents, count(DISTINCT id) AS with_mentions, count(*) AS mentions FROM mentions",
    "corpus_freq": "SELECT chebi_id, freq FROM freq",
    "concept_langs": "SELECT chebi_id, mention_langs FROM langs",
    "corpus_index": "SELECT chebi_id, id, language FROM idx",
    "siblings_isa": f"SELECT * FROM ({_NEAR['siblings_isa']})",
    "siblings_role": f"SELECT * FROM ({_NEAR['siblings_role']})",
    "conjugate_pair": f"SELECT * FROM ({_NEAR['conjugate_pair']})",
    "tautomers": f"SELECT * FROM ({_NEAR['tautomers']})",
    "inchikey_block": f"SELECT * FROM ({_NEAR['stereo_or_tautomer_inchikey_block']})",
    "hydride_family": f"SELECT * FROM ({_NEAR['parent_hydride_family']})",
    "all_neighbors": "SELECT DISTINCT chebi_id, neighbor FROM near",
    "kg_slice": "SELECT s.chebi_id, name AS chebi_name_en, inchikey, formula, star AS chebi_star, parents_isa, roles, coalesce((SELECT string_agg(alias, ',' ORDER BY pos) FROM combined c WHERE c.chebi_id = s.chebi_id AND c.lang = 'en'), '') AS aliases_en, coalesce((SELECT string_agg(DISTINCT neighbor, ',' ORDER BY neighbor) FROM near n WHERE n.chebi_id = s.chebi_id AND n.relation = 'siblings_isa'), '') AS siblings_isa, (SELECT count(*) FROM near n WHERE n.chebi_id = s.chebi_id) AS n_links FROM slice s",
    "concepts_file": "SELECT s.chebi_id, name AS chebi_name_en, inchikey, formula, star AS chebi_star, parents_isa, roles, coalesce((SELECT string_agg(alias, ',' ORDER BY pos) FROM combined c WHERE c.chebi_id = s.chebi_id AND c.lang = 'en'), '') AS aliases_en, coalesce((SELECT string_agg(DISTINCT neighbor, ',' ORDER BY neighbor) FROM near n WHERE n.chebi_id = s.chebi_id AND n.relation = 'siblings_isa'), '') AS siblings_isa, (SELECT count(*) FROM near n WHERE n.chebi_id = s.chebi_id) AS n_links FROM slice s",
    "coarse_types": "SELECT chebi_id, coarse FROM coarse",
    "qualifying_concepts": "SELECT * FROM qual",
    "balanced_sample": f"SELECT chebi_id, star, coarse FROM (SELECT *, row_number() OVER (PARTITION BY star, coarse, alias_lang_count ORDER BY md5(concat_ws('|', '{_S}', 'sample', chebi_id)), chebi_id) AS turn FROM qual) ORDER BY star DESC, turn, md5(concat_ws('|', '{_S}', 'stratum', coarse, alias_lang_count)), chebi_id LIMIT {_CFG.bench1_target}",
    "gold_pick": "SELECT * FROM gold",
    "gold_all": "SELECT chebi_id, language, id FROM idx",
    "hard_negative_pool": "SELECT chebi_id, neighbor, relation, id, language, turn FROM pool",
    "hard_negatives": "SELECT chebi_id, rank, neighbor, relation, id, language FROM negs",
    "neighbor_concepts": "SELECT chebi_id, neighbor, relation, chebi_name_en FROM nearby",
    "bench1_instances": "SELECT m.chebi_id, m.gold_language, m.gold_id AS id, (SELECT to_json(list(n.id ORDER BY n.rank))::VARCHAR FROM negs n WHERE n.chebi_id = m.chebi_id) AS negatives, coalesce((SELECT to_json(list(n.neighbor ORDER BY n.neighbor))::VARCHAR FROM nearby n WHERE n.chebi_id = m.chebi_id), '[]') AS neighbors FROM made m",
    "bench1_summary": f"SELECT (SELECT count(*) FROM made) AS instances_written, (SELECT count(*) FROM qual) AS qualifying_concepts, (SELECT count(*) FROM chosen) AS sampled, {_CFG.bench1_target}::INT AS sample_target, {_S}::INT AS seed, {_tally('SELECT relation AS k FROM negs WHERE chebi_id IN (SELECT chebi_id FROM made)')} AS relation_counts, {_tally('SELECT gold_language AS k FROM made')} AS gold_doc_languages, {_tally('SELECT language AS k FROM negs WHERE chebi_id IN (SELECT chebi_id FROM made)')} AS negative_doc_languages",
    "source_rows": "SELECT id, publication_number, array_to_string(l_avail, ',') AS langs, tokens::INT AS tokens FROM srcrows",
    "source_sample": "SELECT id, publication_number, language FROM sample",
    "noun_words": "SELECT lang, word FROM nounwords",
    "abbreviations": "SELECT lang, word FROM abbr",
    "first_sentences": "SELECT d.id, s.fe::INT AS \"end\", md5(substring(d.text, 1, s.fe::INT)) AS sentence_md5 FROM docs d JOIN docends s USING (id)",
    "positions": "SELECT id, t0::INT AS title_start, t1::INT AS title_end, f0::INT AS first_start, f1::INT AS first_end, CASE WHEN b1 > b0 THEN b0 END::INT AS body_start, CASE WHEN b1 > b0 THEN b1 END::INT AS body_end FROM posn",
    "mention_positions": 'SELECT id, "start", chebi_id, position FROM placed',
    "variant_cells": "SELECT id, variant, position, swap_lang, control_style FROM grid",
    "picked_mentions": "SELECT id, variant, position, swap_lang, original_term, s AS swap_start, chebi_id, fallback_flag FROM picked",
    "prompts": "SELECT p.id, p.variant, p.position, md5(replace(replace(r.rule, '{swap}', p.swap_lang), '{source}', p.language)) AS system_md5, md5('Term: ' || p.original_term || chr(10) || 'Passage: ' || substring(p.text, greatest(1, p.s - 400), 800) || CASE WHEN p.variant = 'B_in_set' AND a.beside <> '' THEN chr(10) || 'Parallel passage: ' || a.beside ELSE '' END) AS user_md5 FROM picked p JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in RULES.items()) + ") AS r(variant, rule) ON r.variant = p.variant LEFT JOIN around a ON a.id = p.pid AND a.chebi_id = p.chebi_id",
    "variant_a": "SELECT concat_ws('__', id, 'A_clean', 'na') AS instance_id, id AS source_row_id, array_to_string(l_avail, ',') AS available_languages, md5(text) AS text_md5 FROM sample",
    "variant_b": f"SELECT {_REC} FROM bcv WHERE variant = 'B_in_set' AND reject_reason IS NULL",
    "variant_c": f"SELECT {_REC} FROM bcv WHERE variant = 'C_out_of_set' AND reject_reason IS NULL",
    "variant_d": f"SELECT {_REC} FROM bcv WHERE variant = 'D_noisy' AND reject_reason IS NULL",
    "variant_e": f"SELECT {_REC} FROM bcv WHERE variant = 'E_control_nonchem' AND reject_reason IS NULL",
    "variants_all": f"SELECT {_REC} FROM bcv WHERE reject_reason IS NULL UNION ALL SELECT concat_ws('__', id, 'A_clean', 'na'), id, array_to_string(l_avail, ','), NULL, NULL, NULL, NULL, NULL, NULL, false, md5(text) FROM sample",
    "variants_file": f"SELECT {_REC} FROM bcv WHERE reject_reason IS NULL UNION ALL SELECT concat_ws('__', id, 'A_clean', 'na'), id, array_to_string(l_avail, ','), NULL, NULL, NULL, NULL, NULL, NULL, false, md5(text) FROM sample",
    "verify_status": "SELECT variant, position, coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n FROM bcv GROUP BY ALL",
    "mentioned_again": "SELECT DISTINCT id, chebi_id FROM mentions",
    "titles_due": "SELECT chebi_id FROM mentions EXCEPT SELECT chebi_id FROM mentions0",
    "source_absent": "SELECT id, variant, position, NOT contains(substring(rewrite, greatest(0, o - 80) + 1, o + length(original_term) + 80 - greatest(0, o - 80)), original_term) AS absent FROM bcv WHERE reject_reason IS NULL",
    "replies": "SELECT item_id, CASE WHEN text IS NOT NULL THEN length(text) || ' 60' END AS response FROM benchmark",
    "model_terms": "SELECT id, variant, position, reverse(original_term) AS swap_term FROM picked",
    "model_checks": "SELECT id, variant, position, swap_term, reject_reason, CASE WHEN variant IN ('B_in_set', 'C_out_of_set') THEN NOT (reject_reason IS NULL AND length(original_term) % 4 = 1) END AS round_trip_flag FROM judged",
    "cache_lookup": f"SELECT sha256('{_S}|' || item_id) AS key, r.response FROM benchmark b LEFT JOIN (SELECT sha256('{_S}|' || replace(key, 'k', '')) AS key, arg_max(response, pos) AS response FROM {_duck(fx.CACHED)} GROUP BY ALL) r ON r.key = sha256('{_S}|' || b.item_id)",
    "token_counts": r"SELECT id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::INT AS tokens FROM docs",
    "url_titles": "SELECT page_id, replace(url_decode(replace(split_part(url, '/', -1), '+', '%2B')), '_', ' ') AS title FROM pages",
}


def oracle_sql() -> dict[str, str]:
    return {k: _with(v) for k, v in SELECTS.items()}
