"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, exact_dedup, lang_id, lattice_lm, merkle, mixing, piece_bpe, quality_rules, sharding, simhash, suffix_dedup, token_store, whitening
from .common import doc_fold, fresh_path

SQL: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_classes(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL["op4_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents
), r AS (
  SELECT doc_id, t, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER w AS nth
  FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(t) AS text_sha256 FROM r
"""


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = byte_bpe.encode_bpe(documents(spark, sf_dir).select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return rows.select("doc_id", F.col("bpe.n_tokens").alias("n_tokens"), F.col("bpe.ids_sha256").alias("ids_sha256"), F.col("bpe.decoded_sha256").alias("decoded_sha256"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    files = token_store.write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_store.read_tokens(spark, files).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = lang_id.held_out(F.col("doc_id"))
    rows = lang_id.identify(docs.select("doc_id", "text"), docs.where(~out))
    return rows.select("doc_id", out.alias("held_out"), F.col("lang_id.lang_pred").alias("lang_pred"), F.col("lang_id.score").alias("score"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), shards=24)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "first_position")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), keep_bytes=False)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document by crc32 is held against the manifest with its text in lower case."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    shown = F.when(doc_fold(F.col("doc_id"), 3) == 0, lower).otherwise(F.col("text"))
    folder = fresh_path(spark, "manifest")
    merkle.build_manifest(documents(spark, sf_dir), folder, beside={"shown": merkle.leaf_digest([*merkle.FIELDS[:-1], shown])})
    return merkle.proofs(spark, folder, presented="shown").withColumnRenamed("id", "doc_id")


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII string, for DuckDB, which has no such function."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {bits}))"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_FIELDS = " || ".join(map(_field, merkle.FIELDS[:-1]))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LIFT = "SELECT tree, lvl + 1, pos // 8, n, sha256(string_agg(h, '' ORDER BY pos)) FROM {0} WHERE n > 8 ** lvl GROUP BY tree, lvl, pos // 8, n"
_BESIDE = """SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {0} a JOIN {0} b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 8 ** a.lvl GROUP BY a.tree, a.lvl, a.pos"""
_FOLD = "SELECT row, f.tree, f.lvl + 1, f.pos // 8, sha256(l || h || r), beside || l || r FROM {0} f JOIN {1} s ON f.tree = s.tree AND f.lvl = s.lvl AND f.pos = s.pos"
SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_FIELDS} || {_field("text")}) AS leaf,
         sha256({_FIELDS} || CASE WHEN {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 THEN {_field(_LOWER)} ELSE {_field("text")} END) AS shown
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d
), nodes(tree, lvl, pos, n, h) AS (SELECT tree, 0, pos, n, leaf FROM ranked UNION ALL {_LIFT.format("nodes")}
), subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n <= 8 ** lvl
), tops(tree, lvl, pos, n, h) AS (SELECT '*', 0, pos, n, h FROM subroots UNION ALL {_LIFT.format("tops")}
), beside1 AS ({_BESIDE.format("nodes")}), beside2 AS ({_BESIDE.format("tops")}
), fold1(row, tree, lvl, pos, h, beside) AS (SELECT row, tree, 0, pos, shown, '' FROM ranked UNION ALL {_FOLD.format("fold1", "beside1")}
), fold2(row, tree, lvl, pos, h, beside) AS (
  SELECT row, '*', 0, s.pos, f.h, beside FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY lvl DESC) AS last FROM fold1) f JOIN subroots s ON f.tree = s.tree WHERE last = 1
  UNION ALL {_FOLD.format("fold2", "beside2")}
), folded AS (SELECT row, arg_max(h, lvl) AS h, arg_max(beside, lvl) AS beside FROM fold2 GROUP BY row
), root AS (SELECT h FROM tops WHERE n <= 8 ** lvl)
SELECT r.doc_id, r.leaf, s.h AS subroot, root.h AS root, sha256(f.beside) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM ranked r JOIN subroots s ON r.tree = s.tree JOIN folded f ON r.row = f.row, root
"""


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_bpe.encode_pieces(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "pieces.n_tokens", "pieces.ids_sha256", "pieces.decoded_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=4)


QUERIES = {f.__name__: f for f in (op1_simhash, op2_lattice_lm, op3_suffix_dedup, op4_exact_dedup, op5_token_store, op6_byte_bpe, op7_lang_id, op8_quality_rules, op9_sharding, op10_mixing, op11_merkle_manifest, op12_sentencepiece, op13_whitening)}
