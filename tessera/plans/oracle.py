"""DuckDB SQL for the core's queries, written from the definitions, independent of the Spark expressions.

Left out, as SQL there lacks what they need: compatibility folding of words (word_counts, toxicity_flags,
contamination_hits, eval_grams, verdict_*), BLAKE2b (doc_hashes, corpus_hash, neardup_drop_list), CRC-32 MinHash
(neardup_*), checksums (pii_scan, pii_redact), tokenizers (token_ratio). These have tests of their own.
"""

from __future__ import annotations

from tessera.functions.domain import BFSI_TERMS, INDIC_LANGS
from tessera.functions.quality import BOILERPLATE
from tessera.operators.gate import ALLOWED, FORBIDDEN, REQUIRED
from tessera.operators.neardup import SQL_PRIME, sql_multipliers


def _list(xs) -> str:
    return "(" + ", ".join("'" + str(x).replace("'", "''") + "'" for x in xs) + ")"


_LANG = "nullif(lower(regexp_extract(trim(lang), '^([^-_]*)', 1)), '')"

# White space and line ends of Python's strings, as RE2 classes.
_WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_EOL = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_OK = r"\p{L}\p{N}_" + _WS + r"\x{900}-\x{DFF}\x{600}-\x{6FF}\x{750}-\x{77F}\x{200C}\x{200D}"

_QUALITY = f"""
WITH p AS (SELECT *, text AS probe FROM documents),
w AS (SELECT *, string_split_regex(regexp_replace(probe, '^[{_WS}]+|[{_WS}]+$', '', 'g'), '[{_WS}]+') AS ws,
  list_filter(string_split_regex(probe, '{_EOL}'), lambda x: regexp_replace(x, '[{_WS}]+', '', 'g') <> '') AS ls FROM p),
m AS (SELECT *, length(regexp_replace(probe, '[{_OK}]+', '', 'g')) / greatest(length(probe), 1) AS symbol_ratio,
  length(regexp_replace(probe, '[^\\p{{Nd}}]+', '', 'g')) / greatest(length(probe), 1) AS digit_ratio,
  list_sum(list_transform(ws, lambda x: length(x))) / greatest(len(ws), 1) AS mean_word_len,
  CASE WHEN len(ls) >= 5 THEN 1.0 - len(list_distinct(ls)) / len(ls) ELSE 0.0 END AS dup_line_frac,
  CASE WHEN len(ws) >= 20 THEN list_max(map_values(list_aggregate(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]), 'histogram'))) / (len(ws) - 1) ELSE 0.0 END AS top_bigram_frac,
  {" + ".join(f"(contains(lower(probe), '{b}'))::BIGINT" for b in BOILERPLATE)} AS boilerplate_hits FROM w),
s AS (SELECT *, greatest(0.0, 1.0 - (
  CASE WHEN symbol_ratio > 0.12 THEN least(0.3, (symbol_ratio - 0.12) * 2.5) ELSE 0 END
  + CASE WHEN digit_ratio > 0.15 THEN least(0.3, (digit_ratio - 0.15) * 2) ELSE 0 END
  + CASE WHEN mean_word_len > 14 OR mean_word_len < 1.5 THEN 0.2 ELSE 0 END
  + CASE WHEN dup_line_frac > 0.3 THEN least(0.3, dup_line_frac - 0.3 + 0.1) ELSE 0 END
  + CASE WHEN top_bigram_frac > 0.08 THEN least(0.25, (top_bigram_frac - 0.08) * 2) ELSE 0 END
  + least(0.3, 0.08 * boilerplate_hits) + CASE WHEN length(text) > 500000 THEN 0.1 ELSE 0 END)) AS raw FROM m),
q AS (SELECT *, CASE WHEN length(text) < 200 THEN least(raw, 0.3) ELSE raw END AS score FROM s),
z AS (SELECT *, CASE WHEN score >= 0.75 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS quality_bucket FROM q)
"""

_SCRIPTS = {"deva": r"\x{900}-\x{97F}", "beng": r"\x{980}-\x{9FF}", "guru": r"\x{A00}-\x{A7F}", "gujr": r"\x{A80}-\x{AFF}", "orya": r"\x{B00}-\x{B7F}", "taml": r"\x{B80}-\x{BFF}", "telu": r"\x{C00}-\x{C7F}", "knda": r"\x{C80}-\x{CFF}", "mlym": r"\x{D00}-\x{D7F}", "arab": r"\x{600}-\x{6FF}\x{750}-\x{77F}", "latn": "A-Za-z"}
_SCRIPT = f"""
WITH c AS (SELECT *, [{", ".join(f"length(regexp_replace(text, '[^{cls}]+', '', 'g'))" for cls in _SCRIPTS.values())}] AS n FROM documents),
s AS (SELECT *, CASE WHEN list_sum(n) > 0 THEN {list(_SCRIPTS)}[list_position(n, list_max(n))] END AS script,
  CASE WHEN list_sum(n) > 0 THEN list_max(n) / list_sum(n) ELSE 0.0 END AS share FROM c),
l AS (SELECT *, CASE script WHEN 'guru' THEN 'pan' WHEN 'gujr' THEN 'guj' WHEN 'orya' THEN 'ori' WHEN 'taml' THEN 'tam' WHEN 'telu' THEN 'tel'
  WHEN 'knda' THEN 'kan' WHEN 'mlym' THEN 'mal' WHEN 'arab' THEN 'urd' WHEN 'latn' THEN 'eng' END AS sl FROM s)
"""


def _fits(lang: str) -> str:
    return f"coalesce(CASE WHEN sl IS NOT NULL THEN sl = {lang} WHEN script = 'deva' THEN {lang} IN ('hin', 'mar', 'nep', 'san') WHEN script = 'beng' THEN {lang} IN ('ben', 'asm') END, false)"


# Boundaries that consume a character, as RE2 has no lookaround; only whether a pattern occurs is asked.
_B, _E, _N = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])", r"[^\p{L}\p{N}_\n]"
_CODE = (
    _B + r"def [a-z_]+\(", _B + r"function\s*[a-zA-Z_]*\(", _B + r"class\s+[A-Z]", _B + r"import\s+[a-z_.]+", r"#include\s*<",
    _B + r"public\s+static" + _E, r"console\.log", _B + rf"SELECT(?:{_N}|{_N}[^\n]{{0,78}}{_N})FROM" + _E, r"</[a-z]+>", r"=>",
    _B + rf"return(?:;|{_N}[^\n]{{0,39}};)", _B + r"(?:null|None|nullptr)" + _E, r"[{}();]\s*\n\s*[{}();]",
)
_REASON = (
    *(_B + w + _E for w in ("theorem", "proof", "lemma", "equation", "probability", "algorithm", "solve for", r"step \p{Nd}", "therefore")),
    r"[∴∵∑∫√≤≥≠]", r"\p{Nd}\s*[+\-×*/=]\s*\p{Nd}", _B + r"q\.?e\.?d" + _E, "प्रमेय", "समीकरण", "हल कीजिए",
)
_DOMAIN = f"""
WITH p AS (SELECT *, text AS probe, lower(text) AS low FROM documents),
n AS (SELECT *, {" + ".join(f"regexp_matches(probe, '{c}')::INT" for c in _CODE)} AS code,
  {" + ".join(f"contains(low, '{t}')::INT" for t in BFSI_TERMS)} AS bfsi,
  {" + ".join(f"regexp_matches(probe, '(?i){r}')::INT" for r in _REASON)} AS reasoning FROM p)
SELECT shard_id, CASE WHEN text IS NULL THEN NULL WHEN code >= 2 THEN 'coding' WHEN bfsi >= 3 THEN 'bfsi' WHEN reasoning >= 2 THEN 'reasoning'
  WHEN lower(trim(lang)) IN {_list(INDIC_LANGS)} THEN 'indic' ELSE 'general' END AS domain, count(*) AS docs FROM n GROUP BY ALL
"""

_GATE = f"""
WITH k AS (SELECT *, lower(trim(coalesce(data_class, ''))) AS kind,
  list_filter([{", ".join(f"CASE WHEN trim(coalesce({f if f != 'language' else chr(34) + 'language' + chr(34)}, '')) = '' THEN '{f}' END" for f in REQUIRED)}], lambda x: x IS NOT NULL) AS blank,
  concat_ws(' ', shard_id, path, source) AS named,
  row_number() OVER (PARTITION BY shard_id ORDER BY path NULLS FIRST, source NULLS FIRST, license NULLS FIRST, date_acquired NULLS FIRST, data_class NULLS FIRST, "language" NULLS FIRST, reviewed_by NULLS FIRST) AS nth
  FROM registry_shards),
g AS (SELECT *, CASE WHEN nth > 1 AND shard_id IS NOT NULL THEN 'duplicate shard_id' WHEN kind IN {_list(FORBIDDEN)} THEN 'forbidden data_class: ' || kind
  WHEN len(blank) > 0 THEN 'missing fields: ' || array_to_string(blank, ', ') WHEN kind NOT IN {_list(ALLOWED)} THEN 'unknown data_class: ' || kind
  WHEN regexp_matches(named, '(?i)customer|client|tenant|pilot|prod[-_]?log|bpo[-_]?qa|ticket') AND trim(coalesce(reviewed_by, '')) = '' THEN 'suspect name without reviewer' END AS reason FROM k)
"""

# Boundaries consume a character here too; only whether a preview holds the kind is asked.
_W = r"\p{L}\p{N}_"
_KINDS = {
    "email": rf"[{_W}.+-]+@[{_W}-]+(?:\.[{_W}-]+)*\.[A-Za-z]{{2,}}(?:$|[^{_W}])",
    "phone_in": rf"(?:^|[^{_W}])(?:\+91[\s-]?|0)?[6-9]\p{{Nd}}{{9}}(?:$|[^\p{{Nd}}])",
    "aadhaar": r"(?:^|[^\p{Nd}\s-]|(?:^|[^\p{Nd}])[\s-])\p{Nd}{4}[\s-]\p{Nd}{4}[\s-]\p{Nd}{4}(?:$|[^\s\p{Nd}-]|[\s-](?:$|[^\p{Nd}]))",
    "pan": rf"(?:^|[^{_W}])[A-Z]{{5}}\p{{Nd}}{{4}}[A-Z](?:$|[^{_W}])",
    "ip": r"(?:^|[^\p{Nd}])(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}(?:$|[^\p{Nd}])",
}

_TRI = f"""
WITH d AS (SELECT doc_id, {_LANG} AS lang, ' ' || trim(text) || ' ' AS p, ' ' || trim(text) || ' ' AS probe FROM documents WHERE text IS NOT NULL),
t AS (SELECT lang, unnest(list_transform(range(1, len(cs) - 1), lambda i: cs[i] || cs[i + 1] || cs[i + 2])) AS g FROM (SELECT *, string_split(p, '') AS cs FROM d WHERE lang IS NOT NULL AND length(p) >= 3)),
c AS (SELECT lang, substring(g, 1, 2) AS ctx, substring(g, 3, 1) AS nxt, count(*) AS n FROM t GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, ctx ORDER BY n DESC, nxt) AS k FROM c),
top AS (SELECT lang, ctx FROM (SELECT lang, ctx, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, ctx) AS k FROM c GROUP BY lang, ctx) WHERE k <= 100000),
model AS (SELECT r.lang, r.ctx, r.nxt, r.n FROM r SEMI JOIN top USING (lang, ctx) WHERE k <= 64)
"""
_BITS = (
    _TRI
    + """,
u AS (SELECT lang, unnest(string_split(p, '')) AS ch FROM d WHERE lang IS NOT NULL),
uni AS (SELECT lang, ch, count(*) AS n FROM u GROUP BY ALL),
tot AS (SELECT lang, sum(n) AS n, greatest(count(*), 2) AS v FROM uni GROUP BY lang),
cx AS (SELECT lang, ctx, sum(n) AS t FROM model GROUP BY ALL),
g AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(probe) - 1), lambda i: substring(probe, i, 3))) AS g FROM d WHERE length(probe) >= 12 AND lang IS NOT NULL),
x AS (SELECT g.doc_id, CASE WHEN cx.t IS NOT NULL THEN (coalesce(m.n, 0) + 0.1::DOUBLE) / (cx.t + 0.1::DOUBLE * tot.v) ELSE (coalesce(uni.n, 0) + 0.1::DOUBLE) / (tot.n + 0.1::DOUBLE * tot.v) END AS pr
  FROM g JOIN tot USING (lang) LEFT JOIN cx ON cx.lang = g.lang AND cx.ctx = substring(g.g, 1, 2)
  LEFT JOIN model m ON m.lang = g.lang AND m.ctx = substring(g.g, 1, 2) AND m.nxt = substring(g.g, 3, 1) LEFT JOIN uni ON uni.lang = g.lang AND uni.ch = substring(g.g, 3, 1)),
b AS (SELECT d.doc_id, d.lang, y.bits FROM (SELECT doc_id, """
    + _LANG
    + """ AS lang FROM documents) d LEFT JOIN (SELECT doc_id, avg(-log2(pr)) AS bits FROM x GROUP BY doc_id) y USING (doc_id))
"""
)

_SHINGLES = f"""
WITH w AS (SELECT doc_id, string_split_regex(regexp_replace(lower(text), '^[{_WS}]+|[{_WS}]+$', '', 'g'), '[{_WS}]+') AS ws FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: ('0x' || substring(md5(array_to_string(list_slice(ws, i, i + 4), ' ')), 1, 8))::BIGINT)) AS h FROM w WHERE len(ws) >= 5),
g AS (SELECT doc_id, {", ".join(f"min((h * {a} + {b}) % {SQL_PRIME}) AS h{i}" for i, (a, b) in enumerate(sql_multipliers(8)))} FROM s GROUP BY doc_id)
"""

SQL = {
    "exact_dedup_stats": "SELECT source, count(*) AS docs, count(DISTINCT text) AS unique_docs, count(*) - count(DISTINCT text) AS exact_dup_docs, round((count(*) - count(DISTINCT text)) / count(*), 6) AS dup_rate FROM documents GROUP BY source",
    "exact_dedup_intra_cross": """WITH per AS (SELECT text, shard_id, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY ALL), e AS (SELECT text, sum(n) AS n, count(*) AS g FROM per GROUP BY text)
SELECT sum(n)::BIGINT AS docs, count(*) AS unique_docs, sum(n - 1)::BIGINT AS global_dups, sum(g - 1)::BIGINT AS cross_dups, sum(n - g)::BIGINT AS intra_dups FROM e""",
    "keep_first": "SELECT doc_id, text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS is_first FROM documents",
    "stride_sample": "SELECT doc_id, doc_index // 50 + 1 AS ordinal FROM documents WHERE doc_index % 50 = 0",
    "nested_stride": "SELECT doc_id, doc_index // 50 + 1 AS ordinal FROM documents WHERE doc_index % 50 = 0 AND (doc_index // 50 + 1) % 4 = 0",
    "byte_budget_sample": """SELECT doc_id, shard_id, n_bytes FROM (SELECT doc_id, shard_id, strlen(text) AS n_bytes,
  coalesce(sum(strlen(text)) OVER (PARTITION BY shard_id ORDER BY doc_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents
  WHERE shard_id IS NOT NULL AND doc_index IS NOT NULL AND text IS NOT NULL) WHERE before < 20000""",
    "provenance_gate": _GATE + "SELECT shard_id, path, reason FROM g",
    "admitted_docs": _GATE + "SELECT d.shard_id, count(*) AS docs, sum(strlen(text))::BIGINT AS doc_bytes FROM documents d WHERE d.shard_id IN (SELECT shard_id FROM g WHERE reason IS NULL) GROUP BY d.shard_id",
    "licence_rollup": _GATE + "SELECT kind AS data_class, license, count(*) AS shards, grouping(kind, license) AS level FROM g WHERE reason IS NULL GROUP BY ROLLUP (kind, license)",
    "quality_metrics": _QUALITY
    + """SELECT doc_id, round(symbol_ratio, 6) AS symbol_ratio, round(digit_ratio, 6) AS digit_ratio, round(mean_word_len, 6) AS mean_word_len, round(dup_line_frac, 6) AS dup_line_frac,
  round(top_bigram_frac, 6) AS top_bigram_frac, boilerplate_hits, round(score, 4) AS quality_score, quality_bucket FROM z""",
    "quality_buckets": _QUALITY + "SELECT shard_id, quality_bucket, count(*) AS docs, round(avg(digit_ratio), 6) AS mean_digit_ratio FROM z GROUP BY ALL",
    "quality_histogram": _QUALITY + "SELECT least(9, floor(round(score, 4) * 10))::INT AS bin, count(*) AS docs FROM z GROUP BY ALL",
    "script_lid": _SCRIPT + 'SELECT doc_id, script, round(share, 6) AS share, sl AS "language" FROM l',
    "lid_purity": _SCRIPT
    + f"""SELECT l.shard_id, r.declared, count(*) AS docs, round(avg(({_fits("lower(r.declared)")})::INT), 6) AS purity, round(avg(share), 6) AS mean_share
  FROM l JOIN (SELECT shard_id, max("language") AS declared FROM registry_shards WHERE shard_id IS NOT NULL GROUP BY shard_id) r USING (shard_id) GROUP BY ALL""",
    "top_languages": _SCRIPT + f"""SELECT coalesce(sl, CASE WHEN {_fits("lower(trim(lang))")} THEN lower(trim(lang)) END, 'und') AS "language", count(*) AS docs FROM l GROUP BY ALL ORDER BY docs DESC, "language" LIMIT 25""",
    "domain_mix": _DOMAIN,
    "lexicon_terms": "SELECT DISTINCT lower(trim(term)) AS term FROM (SELECT term FROM abuse_terms UNION ALL SELECT * FROM (VALUES ('idiot'), ('Dolt ')))",
    "eval_set_build": r"""WITH t AS (SELECT coalesce(source, 'unknown') AS source, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM eval_set), o AS (SELECT text, min(source) AS source FROM t WHERE length(text) >= 40 GROUP BY text)
SELECT regexp_extract(source, '([^/]*)$', 1) || ':' || substring(sha256(text), 1, 10) AS id, source, text FROM o""",
    "pii_kinds": " UNION ".join(f"SELECT DISTINCT drop_id, '{k}' AS kind FROM drops WHERE regexp_matches(preview, '{p}')" for k, p in _KINDS.items()),
    "pii_pan": r"SELECT DISTINCT drop_id, n FROM (SELECT drop_id, len(regexp_extract_all(regexp_replace(preview, '([^\p{L}\p{N}_])', '\1\1', 'g'), '(?:^|[^\p{L}\p{N}_])[A-Z]{5}\p{Nd}{4}[A-Z](?:$|[^\p{L}\p{N}_])')) AS n FROM drops) WHERE n > 0",
    "char_trigram_train": _TRI + "SELECT lang, ctx, nxt, n FROM model",
    "bits_per_char": _BITS + "SELECT doc_id, round(bits, 3) AS bits FROM b",
    "ppx_percentiles": _BITS
    + """SELECT lang, count(*) AS scored, round(avg(bits) + 1e-7, 3) AS mean, round(quantile_cont(bits, 0.5) + 1e-7, 3) AS p50, round(quantile_cont(bits, 0.9) + 1e-7, 3) AS p90,
  round(quantile_cont(bits, 0.99) + 1e-7, 3) AS p99, round(max(bits) + 1e-7, 3) AS max FROM b WHERE bits IS NOT NULL GROUP BY lang""",
    "ppx_cutoffs": _BITS + "SELECT lang, count(*) AS scored, round(CASE WHEN count(*) >= 200 THEN quantile_cont(bits, 0.99) END + 1e-7, 3) AS cutoff FROM b WHERE bits IS NOT NULL GROUP BY lang",
    "score_percentiles": """SELECT shard_id, count(*) AS scored, round(avg(bits_per_char) + 1e-7, 4) AS mean, round(quantile_cont(bits_per_char, 0.5) + 1e-7, 4) AS p50, round(quantile_cont(bits_per_char, 0.9) + 1e-7, 4) AS p90,
  round(quantile_cont(bits_per_char, 0.99) + 1e-7, 4) AS p99, round(max(bits_per_char) + 1e-7, 4) AS max FROM doc_scores WHERE bits_per_char IS NOT NULL GROUP BY shard_id""",
    "minhash_sql": _SHINGLES + "SELECT * FROM g",
    "lsh_bands": _SHINGLES
    + """, b AS (SELECT doc_id, 0 AS band, concat_ws('-', h0, h1, h2, h3) AS key FROM g UNION ALL SELECT doc_id, 1, concat_ws('-', h4, h5, h6, h7) FROM g)
SELECT band, key, count(*) AS docs, min(doc_id) AS representative FROM b GROUP BY ALL""",
    "drops_by_reason": """WITH o AS (SELECT coalesce(reason, 'unknown') AS reason, count(*) AS n FROM (SELECT DISTINCT drop_id, reason FROM drops) GROUP BY ALL),
e AS (SELECT unnest(['exact_dup', 'near_dup', 'quality', 'perplexity', 'toxicity', 'contamination', 'pii']) AS reason) SELECT reason, coalesce(n, 0) AS drops FROM e FULL JOIN o USING (reason)""",
    "attest_files": """WITH a AS (SELECT shard_id, count(*) AS docs, sum(strlen(text))::BIGINT AS bytes, count(DISTINCT text) AS unique_docs, grouping(shard_id) AS level FROM documents WHERE text IS NOT NULL GROUP BY ROLLUP (shard_id))
SELECT *, round(1 - unique_docs / docs, 6) AS dup_rate FROM a""",
    "manifest_rollup": """WITH n AS (SELECT *, row_number() OVER (PARTITION BY shard.shard_id ORDER BY generated_utc DESC, run_id DESC) AS k FROM shard_stats WHERE shard.shard_id IS NOT NULL)
SELECT count(*) AS shards, sum(full_pass.file_bytes)::BIGINT AS file_bytes, sum(full_pass.docs)::BIGINT AS docs, sum(full_pass.doc_bytes)::BIGINT AS doc_bytes, sum(full_pass.exact_dup_docs)::BIGINT AS exact_dup_docs,
  sum(full_pass.unique_docs)::BIGINT AS unique_docs, CASE WHEN bool_and(tokens.estimated_shard_tokens IS NOT NULL) THEN sum(tokens.estimated_shard_tokens)::BIGINT END AS estimated_total_tokens,
  round(coalesce(avg(lid.consistency_rate), 0), 6) AS mean_consistency, round(coalesce(sum(full_pass.exact_dup_docs) / nullif(sum(full_pass.docs), 0), 0), 6) AS dup_rate FROM n WHERE k = 1""",
    "build_union": """WITH r AS (SELECT DISTINCT text, 1 AS p FROM documents WHERE shard_id[1] IN ('v', 'k') UNION ALL SELECT DISTINCT text, 2 FROM documents WHERE shard_id[1] IN ('l', 's', 'c', 'p')), e AS (SELECT text, count(*) AS n FROM r GROUP BY text)
SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_docs, (sum(n) - count(*))::BIGINT AS cross_partition_rekept_docs FROM e""",
    "measured_missing": "SELECT DISTINCT concat_ws(':', shard_id, doc_index) AS record FROM documents WHERE concat_ws(':', shard_id, doc_index) NOT IN (SELECT concat_ws(':', shard_id, doc_index) FROM doc_scores WHERE bits_per_char IS NOT NULL)",
    "html_strip": r"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace('<html><style>p {color: red}</style><!-- a <b> comment --><SCRIPT type=''x''>var a = 1 < 2;</SCRIPT><p class=''y''>' || regexp_replace(text, '[<>&]', ' ', 'g') || '</p>' || chr(10) || chr(10) || '<br/>Tom &amp; Co&nbsp;end</html>',
    '(?is)<style.*?</style>|<script.*?</script>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '&amp;', '&'), '&nbsp;', ' '), '[ \t\x{A0}]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS text FROM documents""",
}
