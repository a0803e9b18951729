"""Registered queries of this package, and their SQL where SQL can express them.

Each applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm import (
    alignment, decontaminate, jaccard, line_dedup, lm, merkle, packing, pii, quality, rules, secrets, sharding, toxicity)
from logweft.llm.text import crc_rest

VOCABULARY = os.environ.get("LOGWEFT_BPE_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")
PIECES = os.environ.get("LOGWEFT_PIECE_MODEL") or public_tokenizers.path("piece_bpe_32k.model")


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), packing.PackConfig(VOCABULARY))


def op2_sharding(spark, sf_dir):
    """The shard of every document."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def _of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op3_pii(spark, sf_dir):
    """Personal data in every document; counts and digest are of the base spans."""
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("pii", lambda s: s["base"])
    return found.select(
        "doc_id", *[_of_kind(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"), pii.spans_text(F.col("pii")).alias("spans"))


def op4_decontamination(spark, sf_dir):
    """Documents that overlap a benchmark text."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_secrets(spark, sf_dir):
    """Candidates for secrets in all documents, and whether they are."""
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    """Quality scores, learned from documents that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_rest("doc_id", 5) == 0
    weights = quality.train_quality(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return quality.score_quality(docs, weights, score="score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_lm_scores(spark, sf_dir):
    """Log10 probabilities, learned from documents that are not held out."""
    return lm.score_texts(_table(spark, sf_dir, "documents"), crc_rest("doc_id", 7) == 2)


def op8_toxicity(spark, sf_dir):
    """Probabilities of toxicity categories."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train_chain(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score_toxicity(docs, chain).drop("text")


def op9_jaccard(spark, sf_dir):
    """Components of documents whose three-word shingle sets share nine tenths."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark, sf_dir):
    """Statistics, the base rule, and the verdict of all rules together."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good_probability")


def op11_merkle(spark, sf_dir):
    """Leaves, subroots, root and proofs of all documents; every second one, by the hash of its id, is tampered with."""
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(crc_rest("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select(
        F.col("source").alias("tree"), F.col("doc_id").alias("key"), merkle.leaf_hash(*fields, F.col("text")).alias("leaf"),
        merkle.leaf_hash(*fields, tampered).alias("claimed"))
    return merkle.manifest(leaves).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_line_dedup(spark, sf_dir):
    """What is left of all documents without lines that other documents have."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_alignment(spark, sf_dir):
    """Groups and links of two tokenizers over all documents."""
    return alignment.align(_table(spark, sf_dir, "documents"), alignment.AlignConfig(VOCABULARY, PIECES))


QUERIES = {
    f.__name__: f for f in (
        op1_packing, op2_sharding, op3_pii, op4_decontamination, op5_secrets, op6_quality, op7_lm_scores, op8_toxicity,
        op9_jaccard, op10_quality_rules, op11_merkle, op12_line_dedup, op13_alignment)}

_KEY = r"""translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

_OP12 = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM numbered),
keyed AS (SELECT *, {_KEY} AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, shared.k IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: crc32 of a decimal id, bit by bit: the tables of DuckDB have no such function.
_CRC_LOW_BIT = """(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: [256 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda s, c: CASE WHEN c >= 256 THEN xor(s, c - 256) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END) & 1)"""

_OP11 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC_LOW_BIT} = 1 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS claimed
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
own AS (
  SELECT 0 AS level, source, pos, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT level + 1, source, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM own WHERE n > 1 GROUP BY level, source, pos // 3),
subroots AS (
  SELECT source, level AS height, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM own WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, subroot AS node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, pos // 3),
above AS (SELECT node AS root, level AS top FROM tops WHERE n = 1),
steps AS (
  SELECT p.doc_id, p.leaf, p.pos AS leaf_pos, p.source, o.level, p.pos // (3 ** o.level)::BIGINT AS own_pos, o.pos, o.node
  FROM placed p JOIN own o ON o.source IS NOT DISTINCT FROM p.source AND o.n > 1
       AND o.pos // 3 = p.pos // (3 ** (o.level + 1))::BIGINT
  UNION ALL
  SELECT p.doc_id, p.leaf, p.pos, p.source, s.height + t.level, s.pos // (3 ** t.level)::BIGINT, t.pos, t.node
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN tops t ON t.n > 1
       AND t.pos // 3 = s.pos // (3 ** (t.level + 1))::BIGINT),
proofs AS (
  SELECT source, leaf_pos, sha256(coalesce(string_agg(node, '' ORDER BY level, pos) FILTER (pos <> own_pos), '')) AS proof_sha256
  FROM steps GROUP BY source, leaf_pos),
runs AS (
  SELECT source, leaf_pos, level, coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos < own_pos), '') AS before,
         coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos > own_pos), '') AS after
  FROM steps GROUP BY source, leaf_pos, level),
folds AS (
  SELECT source, pos AS leaf_pos, 0 AS level, claimed AS node FROM placed
  UNION ALL
  SELECT f.source, f.leaf_pos, f.level + 1, sha256(r.before || f.node || r.after)
  FROM folds f JOIN runs r ON r.source IS NOT DISTINCT FROM f.source AND r.leaf_pos = f.leaf_pos AND r.level = f.level)
SELECT p.doc_id, p.leaf, s.subroot, a.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = a.root AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN above a
JOIN folds f ON f.source IS NOT DISTINCT FROM p.source AND f.leaf_pos = p.pos AND f.level = s.height + a.top
LEFT JOIN proofs q ON q.source IS NOT DISTINCT FROM p.source AND q.leaf_pos = p.pos
"""

#: All pairs that share a shingle, counted; then everything that links reach.
_OP9 = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda word: word <> '') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingle
  FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT r.a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM reached r LEFT JOIN sizes ON sizes.doc_id = r.a GROUP BY r.a
"""

#: Tokenizers, trained models and filling by turns are beyond SQL; tests/llm compares with plain Python instead.
ORACLES: dict[str, str] = {"op9_jaccard": _OP9, "op11_merkle": _OP11, "op12_line_dedup": _OP12}
