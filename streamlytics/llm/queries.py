"""The registered queries of this subpackage (``opN_<name>``) and their DuckDB SQL.

Each query applies its operator with production parameters to the whole table and
derives the contract's columns from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontaminate, license_scan, line_dedup, lm_score, merkle, ngram_join, packing, quality_gam, quality_rules, substring_dedup,
               token_counts, toxicity)
from .manifest_sql import manifest_sql
from .tables import read

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the operators take paths as parameters."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(read(spark, sf_dir, "documents"), enough_docs=quality_rules.ENOUGH_DOCS).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_words", "n_removed_lines")


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
line AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS l FROM d),
own AS (SELECT doc_id, source, text, l FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM own GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS x
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, x FROM win GROUP BY doc_id, x HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win JOIN twice USING (doc_id, x)) GROUP BY doc_id),
norm AS (SELECT doc_id, source, text, trim(regexp_replace(translate(l, '{_UPPER}123456789', '{_LOWER}000000000'),
         '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS x FROM own),
hot AS (SELECT source, x, min(doc_id) AS first_doc, count(DISTINCT text) AS docs FROM norm GROUP BY source, x),
host AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
limits AS (SELECT hot.source, x, first_doc FROM hot JOIN host ON hot.source IS NOT DISTINCT FROM host.source
           WHERE hot.docs > 5 AND hot.docs > host.docs * 0.10 OR hot.docs > 20),
gone AS (SELECT n.doc_id, sum(len(string_split(n.x, ' '))) AS w, count(DISTINCT n.x) AS k
         FROM norm n JOIN limits h ON n.source IS NOT DISTINCT FROM h.source AND n.x = h.x
         WHERE n.doc_id <> h.first_doc GROUP BY n.doc_id),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum([length(w) FOR w IN ws]), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(gone.w, 0) AS BIGINT) AS n_removed_words, CAST(coalesce(gone.k, 0) AS BIGINT) AS n_removed_lines
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND n_words - n_removed_words >= 10 AND n_words - n_removed_words >= 0.3 * n_words AS kept
FROM m
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(read(spark, sf_dir, "documents")).drop("text_key", "kept_text_key")


OP2_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
                  unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
o AS (SELECT [doc_id, i] AS place, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws FROM l
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
d AS (SELECT array_to_string(ws, ' ') AS w, any_value(ws) AS ws, min(place) AS first FROM o GROUP BY 1),
long AS (SELECT * FROM d WHERE len(ws) >= 8),
cut AS (SELECT w, first, p, array_to_string(ws[1:p - 1] || ws[p + 1:], ' ') AS v
        FROM (SELECT w, ws, first, unnest(range(1, len(ws) + 1)) AS p FROM long) WHERE len(ws) >= 8),
swap AS (SELECT v, p, min(first) AS best FROM cut GROUP BY v, p HAVING count(*) > 1),
near AS (SELECT w, best FROM cut JOIN swap USING (v, p) WHERE best < first
         UNION ALL SELECT c.w, s.first FROM cut c JOIN long s ON c.v = s.w WHERE s.first < c.first
         UNION ALL SELECT s.w, c.first FROM cut c JOIN long s ON c.v = s.w WHERE c.first < s.first),
keeper AS (SELECT w, min(best) AS best FROM near GROUP BY w)
SELECT place[1] AS doc_id, place[2] AS line_no, CAST(len(o.ws) AS BIGINT) AS n_words,
       coalesce(best, first)[1] AS kept_doc_id, coalesce(best, first)[2] AS kept_line_no,
       CAST(best IS NOT NULL AS INTEGER) AS distance
FROM o JOIN d ON array_to_string(o.ws, ' ') = d.w LEFT JOIN keeper k ON k.w = d.w
WHERE best IS NOT NULL OR place <> first
"""

_SHINGLES = """CASE WHEN len(ws) >= 5 THEN list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)])
                    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END"""
_LOW_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+')"


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_key")


OP4_SQL = f"""
WITH d AS (SELECT doc_id, unnest({_SHINGLES}) AS s FROM (SELECT doc_id, {_LOW_WORDS} AS ws FROM documents)),
i AS (SELECT item_id, unnest({_SHINGLES}) AS s FROM (SELECT item_id, {_LOW_WORDS} AS ws FROM benchmark)),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item FROM c JOIN n USING (item_id) WHERE 5 * n_shared >= 4 * n_item
"""


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents")).drop("text_key")


OP6_SQL = f"""
WITH RECURSIVE t AS (SELECT doc_id, array_to_string(ws, ' ') AS x, {_SHINGLES} AS sh
                     FROM (SELECT doc_id, {_LOW_WORDS} AS ws FROM documents)),
s AS (SELECT doc_id, unnest(sh) AS s FROM t),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b, x.x AS xa, y.x AS xb FROM c JOIN t x ON a = x.doc_id JOIN t y ON b = y.doc_id
         WHERE 5 * n >= 4 * (len(x.sh) + len(y.sh) - n)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
cls AS (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a),
deg AS (SELECT a AS doc_id, count(*) AS n, count(DISTINCT CASE WHEN xa <> xb THEN xb END) AS k FROM link GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(cls.least, doc_id)) AS class_id, coalesce(n, 0) AS n_links, coalesce(k, 0) AS n_text_links
FROM t LEFT JOIN cls USING (doc_id) LEFT JOIN deg USING (doc_id)
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_totals(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_ranges(read(spark, sf_dir, "documents")).drop("text_key")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"),
                        tokenizer_path("byte_bpe_50k.json"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(read(spark, sf_dir, "documents"))


def _op11_sql() -> str:
    low = f"translate({{}}, '{_UPPER}', '{_LOWER}')"
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    base = ", ".join(f"('{label}', {text.split()})" for label, text in license_scan.BASE)
    sets = license_scan.words_of([t for _, t in license_scan.TEMPLATES])
    templates = ", ".join(f"('{label}', {sorted(set(ws))})" for (label, _), ws in zip(license_scan.TEMPLATES, sets))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, t, {words.format('t')} AS ws
           FROM (SELECT doc_id, {low.format("coalesce(text, '')")} AS t FROM documents)),
base AS (SELECT * FROM (VALUES {base}) v(label, ps)),
template AS (SELECT * FROM (VALUES {templates}) v(label, ts)),
place AS (SELECT row, label, p FROM (SELECT row, ws, label, ps, unnest(range(0, len(ws) - len(ps) + 1)) AS p FROM d, base)
          WHERE ws[p + 1:p + len(ps)] = ps),
based AS (SELECT row, count(*) AS n, min(p) AS a, max(p) AS b, list(DISTINCT label) AS ls FROM place GROUP BY row),
block AS (SELECT row, list_distinct({words.format('l')}) AS bs FROM (SELECT row, unnest(string_split(t, chr(10))) AS l FROM d)),
match AS (SELECT row, label, len(list_intersect(ts, bs)) AS c, len(ts) AS n FROM block, template),
found AS (SELECT row, max(c / n) AS best, list(DISTINCT label) AS ls FROM match WHERE 5 * c >= 4 * n GROUP BY row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(based.n, 0) AS n_base, a AS first_word, b AS last_word,
       coalesce(array_to_string(list_sort(based.ls), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(based.ls, []) || coalesce(found.ls, []))), ',') AS labels,
       CASE WHEN based.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN based USING (row) LEFT JOIN found USING (row)
"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(x, '[^\x20\x09]+') AS ws
           FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS x
                 FROM documents)),
g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
      FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS m))),
total AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
part AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, max(a) AS longer
         FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM f WHERE m > 2)) GROUP BY ALL),
cand AS (SELECT f.* FROM f LEFT JOIN part USING (lang, phrase) WHERE m > 1 AND (longer IS NULL OR 100 * longer < 100 * f.a)),
cut AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (SELECT cut.lang, cut.phrase, cut.a, k, x.a AS l, y.a AS r, n,
                  (1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a) AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = rest
           JOIN total ON total.lang = cut.lang),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS c FROM scored) WHERE c = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= 2000
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


QUERIES = {"op1_quality_rules": op1_quality_rules, "op2_line_dedup": op2_line_dedup,
           "op3_token_counts": op3_token_counts, "op4_decontamination": op4_decontamination,
           "op5_lm_scoring": op5_lm_scoring, "op6_ngram_join": op6_ngram_join, "op7_packing": op7_packing,
           "op8_quality_classifier": op8_quality_classifier, "op9_toxicity": op9_toxicity,
           "op10_substring_dedup": op10_substring_dedup, "op11_license_scan": op11_license_scan, "op12_collocations": op12_collocations,
           "op13_merkle_manifest": op13_merkle_manifest}
ORACLE = {"op1_quality_rules": OP1_SQL, "op2_line_dedup": OP2_SQL, "op4_decontamination": OP4_SQL,
          "op6_ngram_join": OP6_SQL, "op11_license_scan": _op11_sql(), "op12_collocations": OP12_SQL, "op13_merkle_manifest": manifest_sql()}
