"""Registered queries of the training-data operators: thin applications of
the operators to whole tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bestposition, crosstoken, decontaminate, jaccard, langid, linefreq, mixing, nearvectors, packing, quality, sharding, suffixtree, tokencount
from .common import crc_mod, table

WORD_BPE = "word_bpe_49k.json"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_quality_classifier(spark, sf_dir):
    """Quality score of every document; labels are learned where
    crc32(doc_id) mod 3 is not 1."""
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    model = quality.fit(spark, docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                             (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_differencing_shards(spark, sf_dir):
    """All documents in 8 shards of near-equal bytes, equal texts together."""
    return sharding.shards(spark, table(spark, sf_dir, "documents"), 8)


@query
def op4_line_frequency_rules(spark, sf_dir):
    """Base counts of every document and the verdict on its lines."""
    return linefreq.line_rules(spark, table(spark, sf_dir, "documents"))


ORACLE_SQL["op4_line_frequency_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce(source, '(null)') AS host, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS filled FROM d),
w AS (SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS win FROM d, LATERAL (SELECT unnest(generate_series(1, len(words) - 2)) AS i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
l AS (SELECT doc_id, host, trim(line) AS line FROM (SELECT doc_id, host,
  unnest(string_split(regexp_replace(lower(text), '[^\\p{{L}}\\n]+', ' ', 'g'), chr(10))) AS line FROM d) WHERE trim(line) <> ''),
freq AS (SELECT host, line FROM l GROUP BY host, line HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= {linefreq.LINE_DOCS}),
lw AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS line_words,
  sum(CASE WHEN (host, line) IN (SELECT (host, line) FROM freq) THEN len(string_split(line, ' ')) ELSE 0 END) AS removed_words FROM l GROUP BY doc_id),
b AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(filled) - len(list_distinct(filled)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(line_words, 0) AS line_words, coalesce(removed_words, 0) AS removed_words
  FROM d JOIN f USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN lw USING (doc_id)),
e AS (SELECT *, n_words < {linefreq.MIN_WORDS} OR 100 * n_repeat_words > {linefreq.MAX_REPEATED} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CAST(line_words AS BIGINT) AS line_words, CAST(removed_words AS BIGINT) AS removed_words,
  NOT base_failed AND NOT (line_words - removed_words) * 100 < line_words * {linefreq.LEAST_LEFT} AS kept FROM e"""


@query
def op5_token_counts(spark, sf_dir):
    """Greedy longest-match token counts of every document."""
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


# The mixture of op6: three fifths of all tokens, at most two epochs.
MIX_FRACTION, MIX_EPOCHS, MIX_SEED = (3, 5), 2, "mix-1"
MIX_WEIGHTS = {"domain": {"domain0": 5, "domain1": 2, "domain2": 1, "domain3": 1},
               "lang": {"en": 2, "de": 3, "es": 4}, "source": {"src0": 3, "src1": 2}}


@query
def op6_hierarchical_mixing(spark, sf_dir):
    """Documents chosen for the target mixture, with their epoch."""
    return (mixing.mix(spark, table(spark, sf_dir, "documents"), MIX_FRACTION, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED)
            .select("doc_id", "domain", "lang", "source", "n_tokens", "epoch"))


def _mix_sql() -> str:
    def weight(level):
        cases = " ".join(f"WHEN '{name}' THEN {w}" for name, w in MIX_WEIGHTS[level].items())
        return f"CASE {level} {cases} ELSE 1 END"

    def shared(level, parent, budgets):
        over = f"PARTITION BY {parent} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        return f"""
{level}_n AS (SELECT {parent}, {level}, sum(cap) AS cap, {weight(level)} AS w FROM leaf GROUP BY {parent}, {level}),
{level}_b AS (SELECT n.*, b.budget FROM {level}_n n JOIN {budgets} b USING ({parent})),
{level}_f AS (SELECT *, cap * (sum(w) OVER (PARTITION BY {parent}) - coalesce(sum(w) OVER ({over}), 0))
  <= (budget - coalesce(sum(cap) OVER ({over}), 0)) * w AS is_full FROM {level}_b),
{level}_s AS (SELECT {parent}, {level}, CASE WHEN is_full THEN cap ELSE
  ((budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY {parent})) * w)
  // greatest(1, sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (PARTITION BY {parent})) END AS budget FROM {level}_f)"""

    num, den = MIX_FRACTION
    return f"""
WITH d AS (SELECT doc_id, 0 AS root, 'domain' || CAST(CAST('0x' || substr(md5(coalesce(source, '(none)')), 1, 4) AS INT) % 4 AS VARCHAR) AS domain,
  coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS n_tokens FROM documents),
leaf AS (SELECT root, domain, lang, source, sum(n_tokens) AS tokens, {MIX_EPOCHS} * sum(n_tokens) AS cap FROM d GROUP BY ALL),
top AS (SELECT 0 AS root, least(sum(cap), sum(tokens) * {num} // {den}) AS budget FROM leaf),
{shared('domain', 'root', 'top')}, {shared('lang', 'root, domain', 'domain_s')}, {shared('source', 'root, domain, lang', 'lang_s')},
plan AS (SELECT l.*, least(s.budget // l.tokens, {MIX_EPOCHS}) AS whole, s.budget - l.tokens * least(s.budget // l.tokens, {MIX_EPOCHS}) AS rest
  FROM leaf l JOIN source_s s USING (root, domain, lang, source)),
c AS (SELECT d.*, whole, rest, md5(concat_ws(':', '{MIX_SEED}', CAST(CAST(whole AS INT) AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))) AS h
  FROM d JOIN plan USING (root, domain, lang, source)),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM c)
SELECT doc_id, domain, lang, source, n_tokens, CAST(e AS INTEGER) AS epoch FROM r, generate_series(0, {MIX_EPOCHS}) AS g(e)
WHERE e < whole OR (e = whole AND upto <= rest)"""


ORACLE_SQL["op6_hierarchical_mixing"] = _mix_sql()


@query
def op7_best_fit_packing(spark, sf_dir):
    """Every document packed into sequences of at most 2048 tokens."""
    return packing.packed_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query
def op9_language_id(spark, sf_dir):
    """Language of every document, learned where crc32(doc_id) mod 4 is
    not 2."""
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2
    return (langid.predict(docs, langid.fit(spark, docs, ~held_out))
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


@query
def op10_pivot_permutation(spark, sf_dir):
    """Near-duplicate classes and link counts of all vectors."""
    return nearvectors.near_vectors(spark, table(spark, sf_dir, "embeddings"), 0.95)


@query
def op1_suffix_tree(spark, sf_dir):
    """Log probability of every document; learned where crc32(doc_id) mod 7
    is not 2."""
    return suffixtree.score(spark, table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


@query
def op8_ngram_jaccard(spark, sf_dir):
    """Near-duplicate components of all documents: word 5-grams, 0.75."""
    return jaccard.near_texts(spark, table(spark, sf_dir, "documents"))


@query
def op11_token_alignment(spark, sf_dir):
    """Tokens of two tokenizers aligned over all documents."""
    return crosstoken.alignment(spark, table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_best_position_search(spark, sf_dir):
    """The 50 best documents for every benchmark item."""
    return bestposition.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op12_best_position_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM documents),
docs AS (SELECT r, doc_id, w, len(w) AS n FROM d WHERE len(w) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_ITEM_WORD}')) AS t FROM benchmark),
post AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM post, c GROUP BY t, n_docs),
m AS (SELECT r, doc_id, 100 - 50 + (50 * n * n_docs) // n_terms AS m FROM docs, c),
s AS (SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN post USING (t) JOIN weight USING (t) JOIN m USING (r) GROUP BY item_id, r),
o AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {bestposition.K}"""


@query
def op13_benchmark_decontamination(spark, sf_dir):
    """What every document shares with the benchmark: windows of 10 words."""
    found = decontaminate.matches(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.coverage()
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE_SQL["op13_benchmark_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW}) AS size, array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW}) - 1], ' ') AS g
  FROM b, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - {decontaminate.WINDOW - 1}))) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
runs AS (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS g FROM d, sizes,
  LATERAL (SELECT unnest(generate_series(1, len(w) - size + 1)) AS i)),
occ AS (SELECT DISTINCT r, i, size, item_id FROM runs JOIN win USING (size, g)),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM occ, LATERAL (SELECT unnest(generate_series(i, i + size - 1)) AS k) GROUP BY r),
its AS (SELECT r, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)"""
