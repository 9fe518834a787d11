"""The queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .codebooks import op13_vector_codes
from .htmltext import op10_html_text
from .jaccard import op7_jaccard_join
from .mixing import op9_mixing
from .packing import op4_packing
from .pieces import op11_piece_codec
from .quality import LINE_LIMIT, NGRAM_LIMITS, op1_repetition_rules
from .runs import op12_periodic_runs
from .sharding import op6_sharding
from .substrings import op5_substring_dedup
from .tokens import op2_token_files
from .topk import op3_top_k
from .toxicity import op8_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repetition_rules": op1_repetition_rules,
    "op2_token_files": op2_token_files,
    "op3_top_k": op3_top_k,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_sharding": op6_sharding,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_html_text": op10_html_text,
    "op11_piece_codec": op11_piece_codec,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}

_WORDS = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _repetition() -> str:
    grams = "SELECT doc_id, i, {n} AS n, array_to_string(w[i:i + {n} - 1], ' ') AS g FROM p WHERE i + {n} - 1 <= len(w)"
    limits = " OR ".join(f"dup_{n}gram_chars > {x} * word_chars" for n, x in NGRAM_LIMITS.items())
    columns = ", ".join(f"coalesce(max(chars) FILTER (n = {n}), 0)::BIGINT AS dup_{n}gram_chars" for n in NGRAM_LIMITS)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS ({' UNION ALL '.join(grams.format(n=n) for n in NGRAM_LIMITS)}),
c AS (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, g) AS k, row_number() OVER (PARTITION BY doc_id, n, g ORDER BY i) AS r FROM g),
later AS (SELECT DISTINCT doc_id, n, i + o AS j FROM c, (SELECT unnest(range(10)) AS o) WHERE r > 1 AND o < n),
spans AS (SELECT doc_id, n, sum(length(w[j])) AS chars FROM later JOIN d USING (doc_id) GROUP BY doc_id, n),
wide AS (SELECT doc_id, {columns} FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
again AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM c, (SELECT unnest(range(5)) AS o) WHERE n = 5 AND k > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d),
x AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r FROM l WHERE len({_WORDS.format('line')}) > 0),
y AS (SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS dup_line_chars FROM x WHERE r > 1 GROUP BY doc_id),
a AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda s: length(s))), 0)::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars FROM d LEFT JOIN y USING (doc_id) LEFT JOIN again USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a JOIN wide USING (doc_id))
SELECT *, NOT (base_failed OR dup_line_chars > {LINE_LIMIT} * word_chars OR {limits}) AS kept FROM b"""


_TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings)
SELECT query_id, rank::INT AS rank, vec_id, score::BIGINT AS score FROM (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score,
row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id) AS rank FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 20"""

_SUBSTRINGS = f"""WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
r AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS j FROM r, (SELECT unnest(range(20)) AS o)),
s AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed, sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(js, k)) END, ' ')) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)"""

_JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
sides AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(a, b) AS (SELECT x, x FROM sides UNION SELECT a, y FROM reach JOIN sides ON b = x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = doc_id"""

#: CRC-32 of a doc_id's digits, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(doc_id::VARCHAR, '.'), lambda s: ascii(s)::BIGINT)),
lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)"""

#: Runs as islands of equal 5-word windows q words apart: no mask, no halving.
_RUNS = f"""WITH t AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w, {_CRC} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM t),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM a),
x AS (SELECT doc_id, n, i, w[i + 1] AS word, md5(array_to_string(w[i + 1:i + 5], ' ')) AS gram FROM (SELECT doc_id, n, w, unnest(range(n)) AS i FROM d)),
e AS (SELECT b.doc_id, b.i, c.i - b.i AS q FROM x b JOIN x c ON b.doc_id = c.doc_id AND b.gram = c.gram AND b.i < c.i WHERE c.i + 5 <= c.n AND 4 * (c.i - b.i) <= b.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS rank FROM r),
f AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256 FROM d LEFT JOIN f USING (doc_id) LEFT JOIN (SELECT * FROM o WHERE rank = 1) USING (doc_id) LEFT JOIN k USING (doc_id)"""



def _codebooks(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Lloyd's rounds with every distance computed: no bounds, no heaps."""
    kept = f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e, len(embedding) // {parts} AS d FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, part, e[part * d + 1:(part + 1) * d] AS x FROM v, (SELECT unnest(range({parts})) AS part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries}))"""
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT vec_id, label, part, x, min(({distance})::BIGINT * {entries} + entry) AS best FROM p JOIN c{k} USING (part) GROUP BY ALL)")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT part, entry, list(y ORDER BY pos) AS c FROM (SELECT part, entry, pos, (sum(z) // count(*) - CASE WHEN sum(z) % count(*) < 0 THEN 1 ELSE 0 END)::BIGINT AS y
FROM (SELECT part, best % {entries} AS entry, unnest(x) AS z, unnest(range(len(x))) AS pos FROM a{k}) GROUP BY part, entry, pos) GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (part, entry))""")
    return f"""{kept}, {', '.join(steps)},
o AS (SELECT vec_id, label, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label),
b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o, b"""


#: The tokenizers, the trained model, CRC-32, the HTML rules and the splitting tree's draws can't be said in SQL; tests hold those against brute force.
ORACLES: dict[str, str] = {
    "op1_repetition_rules": _repetition(),
    "op3_top_k": _TOP_K,
    "op5_substring_dedup": _SUBSTRINGS,
    "op7_jaccard_join": _JACCARD,
    "op12_periodic_runs": _RUNS,
    "op13_vector_codes": _codebooks(),
}
