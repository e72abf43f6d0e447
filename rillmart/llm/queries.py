"""One registered query per operator, with production parameters over its whole table, and SQL where it can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, exact_dedup, language, line_dedup, merkle, mixing, packing, pii, simhash, substring_dedup, token_files, topk,
    whitening,
)
from .shared import documents, folder

Run = Callable[[SparkSession, str], DataFrame]
END_ID = 2
PACK_END_ID = 1
LINE_WORDS = 50
VOCABULARY_FOLDER = "RILLMART_TOKENIZERS"


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies; RILLMART_TOKENIZERS names another folder."""
    if VOCABULARY_FOLDER in os.environ:
        return os.path.join(os.environ[VOCABULARY_FOLDER], name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir, "doc_id", "text"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(documents(spark, sf_dir, "doc_id", "text"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    done = line_dedup.dedup_lines(docs, report=("n_lines", "n_removed"), words=LINE_WORDS)
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("held_out", language.held_out(F.col("doc_id")))
    dictionaries = language.learn(docs.filter("NOT held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), dictionaries)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.dedup_passages(documents(spark, sf_dir, "doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folder(spark, "tokens")
    docs = documents(spark, sf_dir, "doc_id", "text")
    manifest = token_files.write(docs, out, vocabulary("byte_bpe_50k.json"), END_ID)
    return token_files.read(manifest, out)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir, "doc_id", "text"), vocabulary("word_bpe_49k.json"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(name) for name in docs.columns]
    changed = [F.col("n_chars").cast("bigint") + 1 if name == "n_chars" else F.col(name) for name in docs.columns]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    found = merkle.manifest(docs, fields, extra={"tampered": F.when(hit, merkle.record_digest(changed))})
    again = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        again.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir, "doc_id", "text"), vocabulary("byte_bpe_50k.json"), PACK_END_ID)
    return pieces.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


SQL_EXACT_DEDUP = """
WITH plain AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY t)
"""

SQL_LINE_DEDUP = r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM texts),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines),
nearby AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c, words AS words_a,
         words + lead(words, 1) OVER w AS words_b FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
windows AS (
  SELECT doc_id, pos, 3 AS n, a, b, c FROM nearby
  WHERE c IS NOT NULL AND NOT (trim(a) = '' AND trim(b) = '' AND trim(c) = '')
  UNION ALL SELECT doc_id, pos, 2, a, b, NULL FROM nearby WHERE words_b >= 50
  UNION ALL SELECT doc_id, pos, 1, a, NULL, NULL FROM nearby WHERE words_a >= 50),
later AS (
  SELECT doc_id, pos, n FROM (
    SELECT *, row_number() OVER (PARTITION BY n, a, b, c ORDER BY doc_id, pos) AS place FROM windows)
  WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM later),
marked AS (SELECT l.*, g.pos IS NOT NULL AS removed FROM lines l LEFT JOIN gone g USING (doc_id, pos))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL_SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 49], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM texts WHERE len(words) >= 50)),
later AS (
  SELECT doc_id, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY content) AS least FROM windows)
  WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM later),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts),
kept AS (
  SELECT w.doc_id, count(*) FILTER (g.pos IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY w.pos) FILTER (g.pos IS NULL) AS kept
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos GROUP BY w.doc_id)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""

SQL_TOP_K = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

SQL_MERKLE = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars, coalesce('=' || lang, '') AS tree,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
                     lambda crc, byte: list_reduce(range(8), lambda c, i: CASE
                       WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), 4294967295) AS crc
  FROM documents),
digests AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0
           THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS changed
  FROM fields),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS size FROM digests),
nodes AS (
  SELECT tree, 0 AS level, place, size, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE size > 1 GROUP BY tree, level, place // 2, size),
subroots AS (
  SELECT *, row_number() OVER (ORDER BY tree) - 1 AS spot, count(*) OVER () AS trees FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, spot AS place, trees AS size, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE size > 1 GROUP BY level, place // 2, size),
steps AS (
  SELECT tree, level, place, size, digest FROM nodes WHERE size > 1
  UNION ALL
  SELECT s.tree, s.level + t.level, t.place, t.size, t.digest
  FROM subroots s JOIN tops t ON t.size > 1),
climb AS (
  SELECT l.doc_id, l.tree, l.leaf, 0 AS rung, l.place, '' AS proof, coalesce(l.changed, l.leaf) AS digest,
         s.level AS depth, s.spot FROM leaves l JOIN subroots s USING (tree)
  UNION ALL
  SELECT c.doc_id, c.tree, c.leaf, c.rung + 1, here // 2, c.proof || coalesce(n.digest, ''),
         sha256(CASE WHEN here % 2 = 1 THEN n.digest || c.digest ELSE c.digest || coalesce(n.digest, '') END),
         c.depth, c.spot
  FROM (SELECT *, CASE WHEN rung = depth THEN spot ELSE place END AS here FROM climb) c
  LEFT JOIN steps n ON n.tree = c.tree AND n.level = c.rung AND n.place = xor(here::BIGINT, 1::BIGINT)
  WHERE EXISTS (SELECT 1 FROM steps e WHERE e.tree = c.tree AND e.level = c.rung)),
ended AS (SELECT * FROM climb c WHERE NOT EXISTS (SELECT 1 FROM steps e WHERE e.tree = c.tree AND e.level = c.rung))
SELECT e.doc_id, e.leaf, s.digest AS subroot, t.digest AS root, sha256(e.proof) AS proof_sha256,
       e.digest AS folded_root, e.digest = t.digest AS verified
FROM ended e JOIN subroots s USING (tree) JOIN tops t ON t.size = 1
"""

QUERIES: dict[str, tuple[Run, str | None]] = {
    "op1_exact_dedup": (op1_exact_dedup, SQL_EXACT_DEDUP),
    "op2_pii": (op2_pii, None),
    "op3_mixing": (op3_mixing, None),
    "op4_simhash": (op4_simhash, None),
    "op5_line_dedup": (op5_line_dedup, SQL_LINE_DEDUP),
    "op6_language": (op6_language, None),
    "op7_substring_dedup": (op7_substring_dedup, SQL_SUBSTRING_DEDUP),
    "op8_token_files": (op8_token_files, None),
    "op9_bpe": (op9_bpe, None),
    "op10_top_k": (op10_top_k, SQL_TOP_K),
    "op11_merkle": (op11_merkle, SQL_MERKLE),
    "op12_packing": (op12_packing, None),
    "op13_whitening": (op13_whitening, None),
}
