"""DuckDB statements of those queries that SQL can express."""

from .integer_vectors import SCALE
from .op1_quality_rules import FACTOR, LOWER, MAX_REPEAT_PERCENT, MIN_GROUP, MIN_WORDS, SLACK
from .op11_centroid_clusters import DIM, K, SEED
from .op11_centroid_clusters import ROUNDS as KMEANS_ROUNDS
from .op13_vector_codes import ENTRIES, PARTS
from .op13_vector_codes import ROUNDS as CODE_ROUNDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2_SQL = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS j FROM docs WHERE len(ws) >= 50),
wins AS (SELECT doc_id, j, md5(array_to_string(list_slice(ws, j, j + 49), ' ')) AS k FROM starts),
dead AS (SELECT w.doc_id, w.j FROM wins w JOIN (SELECT k, min(doc_id) AS least FROM wins GROUP BY k) m USING (k) WHERE w.doc_id > m.least),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM docs),
marked AS (SELECT w.doc_id, w.j, w.w, max(CASE WHEN d.j IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.doc_id ORDER BY w.j ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
           FROM words w LEFT JOIN dead d ON w.doc_id = d.doc_id AND w.j = d.j),
cut AS (SELECT doc_id, sum(gone) AS n, string_agg(w, ' ' ORDER BY j) FILTER (WHERE gone = 0) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN cut c USING (doc_id)
"""


def _op1() -> str:
    rates = {"symbols": ("n_symbols", 1000), "dup_lines": ("n_dup_lines", 1000), "repeats": ("n_repeat_words", 1000), "word_len": ("word_chars", 100)}
    each = " UNION ALL ".join(f"SELECT coalesce(lang, '') AS l, coalesce(source, '') AS s, '{k}' AS metric, ({c} * {n}) // n_words AS v FROM m WHERE n_words > 0" for k, (c, n) in rates.items())
    exp = "(length(bin(v)) - 6)"
    bucket = f"CASE WHEN v < 64 THEN v ELSE 64 + ({exp} - 1) * 32 + ((v >> {exp}) - 32) END"
    floor_of = lambda b: f"CASE WHEN {b} < 64 THEN {b} ELSE (({b} - 64) % 32 + 32) << (({b} - 64) // 32 + 1)::BIGINT END"
    slack = "CASE metric " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SLACK.items()) + " END"
    lower = ", ".join(f"'{k}'" for k in LOWER)

    def limits(by: str) -> str:
        keys = f"{by}, metric" if by else "metric"
        return f"""SELECT {keys}, total, hi + greatest({FACTOR} * (hi - lo), {slack}) AS up, CASE WHEN metric IN ({lower}) THEN lo - greatest({FACTOR} * (hi - lo), {slack}) ELSE 0 END AS down FROM (
            SELECT {keys}, total, {floor_of("b1")} AS lo, {floor_of("b3")} AS hi FROM (
            SELECT {keys}, max(total) AS total, min(bucket) FILTER (WHERE 100 * seen >= 25 * total) AS b1, min(bucket) FILTER (WHERE 100 * seen >= 75 * total) AS b3 FROM (
            SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY {keys}) AS total FROM (
            SELECT {keys}, bucket, count(*) AS n FROM b GROUP BY {keys}, bucket)) GROUP BY {keys}))"""

    inside = " AND ".join(f"(({c} * {n}) // nullif(n_words, 0) BETWEEN f.d_{k} AND f.u_{k})" for k, (c, n) in rates.items())
    cols = ", ".join(f"max(up) FILTER (WHERE metric = '{k}') AS u_{k}, max(down) FILTER (WHERE metric = '{k}') AS d_{k}" for k in rates)
    return rf"""
WITH docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT l) AS d FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS j FROM docs WHERE len(ws) >= 8),
wins AS (SELECT doc_id, j, count(*) OVER (PARTITION BY doc_id, md5(array_to_string(list_slice(ws, j, j + 7), ' '))) AS c FROM starts),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j FROM docs),
rep AS (SELECT doc_id, sum(hit) AS n FROM (SELECT w.doc_id, max(CASE WHEN x.c > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY w.doc_id ORDER BY w.j ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM words w LEFT JOIN wins x ON w.doc_id = x.doc_id AND w.j = x.j) GROUP BY doc_id),
m AS (SELECT d.doc_id, d.lang, d.source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      coalesce(lines.n - lines.d, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM docs d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
r AS ({each}),
b AS (SELECT *, {bucket} AS bucket FROM r),
own AS ({limits("l, s")}), byl AS ({limits("l")}), al AS ({limits("")}),
f AS (SELECT l, s, {cols} FROM (SELECT o.l, o.s, o.metric, CASE WHEN o.total >= {MIN_GROUP} THEN o.up WHEN y.total >= {MIN_GROUP} THEN y.up ELSE a.up END AS up,
      CASE WHEN o.total >= {MIN_GROUP} THEN o.down WHEN y.total >= {MIN_GROUP} THEN y.down ELSE a.down END AS down FROM own o JOIN byl y USING (l, metric) JOIN al a USING (metric)) GROUP BY l, s),
v AS (SELECT m.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, coalesce({inside}, false) AS ok
      FROM m LEFT JOIN f ON f.l = coalesce(m.lang, '') AND f.s = coalesce(m.source, ''))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept FROM v
"""


OP1_SQL = _op1()

_INTEGERS = f"list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT)"
_SOUND = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_FAR = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
_FLOORED = "((s - ((s % n) + n) % n) // n)::BIGINT"


def _op11() -> str:
    steps = [f"kept AS MATERIALIZED (SELECT vec_id, {_INTEGERS} AS v FROM embeddings WHERE len(embedding) = {DIM} AND {_SOUND})"]
    steps.append(f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k, v AS c FROM kept QUALIFY k < {K})")
    for r in range(KMEANS_ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min({{'d': d, 'k': k}}) AS m FROM (SELECT vec_id, v, k, {_FAR.format('v', 'c')} AS d FROM kept, c{r}) GROUP BY vec_id)")
        sums = f"SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT m.k AS k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY k, i"
        steps.append(f"c{r + 1} AS MATERIALIZED (SELECT o.k, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN (SELECT k, list({_FLOORED} ORDER BY i) AS c FROM ({sums}) GROUP BY k) n ON o.k = n.k)")
    last = KMEANS_ROUNDS
    return f"WITH {', '.join(steps[:-1])} SELECT vec_id, m.k::INT AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.k))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{last} JOIN c{last} ON c{last}.k = m.k"


OP11_SQL = _op11()

OP12_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW g AS (PARTITION BY t)
"""


def _op13() -> str:
    steps = [f"kept AS MATERIALIZED (SELECT vec_id, label, {_INTEGERS} AS v FROM embeddings WHERE len(embedding) > 0 AND {_SOUND})"]
    steps.append(f"parts AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS x FROM kept, (SELECT unnest(range({PARTS})) AS p))")
    steps.append(f"b0 AS MATERIALIZED (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, x AS c FROM parts QUALIFY e < {ENTRIES})")
    for r in range(CODE_ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS m FROM (SELECT vec_id, p, x, e, {_FAR.format('x', 'c')} AS d FROM parts JOIN b{r} USING (p)) GROUP BY vec_id, p)")
        sums = f"SELECT p, e, i, sum(y) AS s, count(*) AS n FROM (SELECT p, m.e AS e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY p, e, i"
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(n.c, o.c) AS c FROM b{r} o LEFT JOIN (SELECT p, e, list({_FLOORED} ORDER BY i) AS c FROM ({sums}) GROUP BY p, e) n ON o.p = n.p AND o.e = n.e)")
    last = CODE_ROUNDS
    coded = f"SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{last} GROUP BY vec_id"
    return f"WITH {', '.join(steps[:-1])} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{last}) AS codebooks_sha256 FROM ({coded}) JOIN kept USING (vec_id)"


OP13_SQL = _op13()
