"""Registered queries of this subpackage, over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import chat, decontam, kn_quality, line_dedup, manifest, mixing, packing, pii, pipeline, quality_rules, simhash, spelling, token_counts, training_order
from gridcast.llm.common import stage_path, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document keeps."""
    found = line_dedup.kept_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_equal", "n_near", F.array_join("kept", ",").alias("kept_lines"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from all documents."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order without quotes, in chat-template form."""
    found = chat.conversations(table(spark, sf_dir, "conversations"))
    key = F.transform("order_key", lambda k: F.concat_ws(":", k.hangs, k.place, k.chain))
    return found.select("conv_id", "turn", "parent", "linked", "depth", F.array_join(key, "/").alias("order_key"),
                        chat.chat_turn(F.col("role"), F.col("content")).alias("message"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexities of all documents and verdicts by language."""
    found = kn_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "perplexity", "perplexity_limit", "hard_word", "hard_word_limit", "kept")


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of all documents in their slots, written as raw shards and read from them."""
    path = stage_path(spark, f"shards-{uuid.uuid4().hex}")
    training_order.write_order(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), path)
    return training_order.read_from(spark, path, 0)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found, _ = pii.personal_data(table(spark, sf_dir, "documents"))
    n = [F.size(F.filter("base", lambda s: s.k == 0)), F.size(F.filter("base", lambda s: s.k == 1)),
         F.size(F.filter("base", lambda s: s.k == 2)), F.size(F.filter("base", lambda s: s.k == 3))]
    return found.select("doc_id", *[x.cast("long").alias(f"n_{k}") for k, x in zip(pii.KINDS, n, strict=True)],
                        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"),
                        F.size("spans").cast("long").alias("n_spans"))


def op10_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of all documents."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdicts of the learned quality rules for all documents."""
    found, _ = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "rule")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words found in all documents."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their forms and roots."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), delete_every=97)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, held against a tampered copy."""
    return manifest.verify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op6_mixing": op6_mixing,
    "op5_chat_format": op5_chat_format,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_training_order": op8_training_order,
    "op9_pii": op9_pii,
    "op10_simhash_neardup": op10_simhash_neardup,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": pipeline.run,
}

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN (SELECT DISTINCT n FROM bw) ON len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

#: CRC-32 with its table made by the rule of the reversed polynomial 0xEDB88320;
#: ``crc_of`` gives the unsigned value of a list of bytes, next to the table ``crc``.
CRC_TABLE = """crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i))"""


def crc_of(byte_list: str) -> str:
    return (f"xor(list_reduce([4294967295::BIGINT] || ({byte_list}), lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)),"
            " 4294967295)")


def _leaf_sql(n_chars: str) -> str:
    fields = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(fields)})"


OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS g, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN {crc_of("list_transform(str_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)")} % 7 = 0
              THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS changed
  FROM documents, crc),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
lv AS (
  SELECT g, 0 AS l, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY g
  UNION ALL
  SELECT g, l + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM lv WHERE len(nodes) > 1),
tops AS (SELECT g, nodes[1] AS subroot, l AS height, row_number() OVER (ORDER BY g) - 1 AS pos FROM lv WHERE len(nodes) = 1),
rl AS (
  SELECT 0 AS l, list(subroot ORDER BY pos) AS nodes FROM tops
  UNION ALL
  SELECT l + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM rl WHERE len(nodes) > 1),
steps AS (
  SELECT p.g, p.pos, lv.l, (p.pos >> lv.l) & 1 AS odd, coalesce(lv.nodes[CAST(xor(p.pos >> lv.l, 1) + 1 AS BIGINT)], '') AS sib
  FROM p JOIN lv ON lv.g = p.g AND len(lv.nodes) > 1
  UNION ALL
  SELECT p.g, p.pos, t.height + rl.l, (t.pos >> rl.l) & 1, coalesce(rl.nodes[CAST(xor(t.pos >> rl.l, 1) + 1 AS BIGINT)], '')
  FROM p JOIN tops t ON t.g = p.g JOIN rl ON len(rl.nodes) > 1),
proof AS (SELECT g, pos, list({{'odd': odd, 'sib': sib}} ORDER BY l) AS path, string_agg(sib, '' ORDER BY l) AS sibs FROM steps GROUP BY g, pos),
fold AS (
  SELECT p.g, p.pos, 0 AS k, changed AS acc, path FROM p LEFT JOIN proof USING (g, pos)
  UNION ALL
  SELECT g, pos, k + 1, CASE WHEN path[k + 1].odd = 1 THEN sha256(path[k + 1].sib || acc) ELSE sha256(acc || path[k + 1].sib) END, path
  FROM fold WHERE k < coalesce(len(path), 0))
SELECT doc_id, leaf, subroot, r.nodes[1] AS root, sha256(coalesce(sibs, '')) AS proof_sha256, acc AS folded_root, acc = r.nodes[1] AS verified
FROM p JOIN (SELECT g, subroot FROM tops) USING (g) LEFT JOIN proof USING (g, pos)
JOIN (SELECT g, pos, acc FROM fold WHERE k = coalesce(len(path), 0)) USING (g, pos)
JOIN (SELECT nodes FROM rl WHERE len(nodes) = 1) r ON TRUE
"""

_WORD_BYTES = """flatten(list_transform(str_split(doc_id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))"""

OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents) WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, c, {crc_of(_WORD_BYTES)} AS h FROM runs, crc),
v AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = less
  UNION
  SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = less),
best AS (SELECT word, count(*) AS n_near, min({{'n': -other_n, 'w': other}}) AS best FROM near GROUP BY word),
f AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 2 * v.n THEN best.w END AS form, CASE WHEN -best.n >= 2 * v.n THEN -best.n END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at_word, form AS ahead FROM f
  UNION ALL
  SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.ahead)
SELECT word, form, at_word AS root, n, n_near, form_n FROM f JOIN (SELECT word, at_word FROM walk WHERE ahead IS NULL) USING (word)
"""

ORACLE: dict[str, str] = {
    "op12_spelling_variants": OP12_SQL,
    "op2_decontamination": OP2_SQL,
    "op13_merkle_manifest": OP13_SQL,
} | ({"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {})
