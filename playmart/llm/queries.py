"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from . import licenses
from .decontaminate import op3_decontaminate
from .fill_middle import op12_fill_middle
from .fingerprints import op7_fingerprints
from .language_id import op2_language_id
from .language_model import op1_language_model
from .licenses import op6_licenses
from .packing import op10_packing
from .periodic_runs import op11_periodic_runs
from .repeats import op13_substring_dedup
from .secrets import op4_secrets
from .simhash import op5_simhash
from .token_counts import op8_token_counts
from .toxicity import op9_toxicity

QUERIES = {
    "op1_language_model": op1_language_model,
    "op2_language_id": op2_language_id,
    "op3_decontaminate": op3_decontaminate,
    "op4_secrets": op4_secrets,
    "op5_simhash": op5_simhash,
    "op6_licenses": op6_licenses,
    "op7_fingerprints": op7_fingerprints,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_fill_middle": op12_fill_middle,
    "op13_substring_dedup": op13_substring_dedup,
}
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_TEMPLATES = ", ".join(f"({k}, '{label}', string_split('{text}', ' '))" for k, (label, text) in enumerate(licenses.TEMPLATES))
_PHRASES = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in licenses.PHRASES.items())

ORACLE: dict[str, str] = {
    "op3_decontaminate": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
grams AS (SELECT DISTINCT item, w[i:i + 9] AS g FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM grams),
spots AS (SELECT r, n, i, w[i:i + n - 1] AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, n, item FROM spots JOIN grams USING (g)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN found USING (r)""",
    "op6_licenses": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
phrases(label, p) AS (VALUES {_PHRASES}),
templates(k, label, t) AS (VALUES {_TEMPLATES}),
places AS (SELECT r, label, i FROM (SELECT r, w, label, p, unnest(range(0, len(w))) AS i FROM d, phrases) WHERE w[i + 1:i + len(p)] = p),
base AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY r),
blocks AS (SELECT r, w[s + 1:s + 64] AS part FROM (SELECT r, w, unnest(range(0, greatest(1, len(w) - 32), 32)) AS s FROM d)),
met AS (SELECT r, label, len(list_intersect(list_distinct(t), part)) / len(list_distinct(t)) AS c FROM blocks, templates),
own AS (SELECT r, label, c FROM met WHERE c >= 0.85 - 1e-9),
tags AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT r, label FROM places UNION ALL SELECT r, label FROM own) GROUP BY r),
best AS (SELECT r, max(c) AS c FROM own GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN tags USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)""",
    "op12_fill_middle": """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
              sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
d AS (SELECT *, len(w) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(w) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(w) + 1) AS c2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM t),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
                     WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form, least(c1, c2) AS a, greatest(c1, c2) AS b FROM d),
p AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""",
    "op13_substring_dedup": r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
first AS (SELECT g, min(doc_id) AS low FROM spots GROUP BY g),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM spots JOIN first USING (g) WHERE doc_id > low)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n
         FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
}
