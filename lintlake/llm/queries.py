"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lintlake.functions.scale import scratch_path
from lintlake.llm import (
    bpe,
    byte_bpe,
    chat,
    dialogue,
    html,
    huffman,
    infill,
    jaccard,
    language_id,
    neighbours,
    packing,
    quality,
    sharding,
)
from lintlake.llm.tokens import vocabulary_path

SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_output_code_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = language_id.train(documents)
    found = language_id.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_consistent_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), SHARDS)


def op3_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), vocabulary_path())


def op4_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary_path()).drop("ids")


def op5_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op7_blocked_product_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op8_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.linked_turns(spark, _table(spark, sf_dir, "conversations"))


def op9_huffman_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "huffman-store")
    huffman.write_store(_table(spark, sf_dir, "documents"), vocabulary_path(), path)
    return huffman.read_store(spark, path).drop("ids")


def op10_descent_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return dialogue.repair(conversations, dialogue.damaged(conversations))


def op12_fenwick_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.transform(_table(spark, sf_dir, "documents"))
    text = infill.restored(F.col("output"), F.col("form"))
    hashes = [F.sha2(F.encode(c, "UTF-8"), 256) for c in (F.col("output"), text)]
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        hashes[0].alias("output_sha256"), hashes[1].alias("restored_sha256"),
    )


def op13_scanned_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_multi_50k.tiktoken"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


#: Line ends are counted and cut with lists; DuckDB has the same hash.
_INFILL_SQL = """
with hashed as (
    select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h,
        regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as units
    from documents
), drawn as (
    select *, len(units) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
        cast('0x' || h[25:32] as bigint) as h4
    from hashed
), cut as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
            when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from drawn
), parts as (
    select *, array_to_string(units[1:a], '') as p, array_to_string(units[a + 1:b], '') as m,
        array_to_string(units[b + 1:], '') as s
    from cut
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
    case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(t) as restored_sha256
from parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_fenwick_infill": _INFILL_SQL}
