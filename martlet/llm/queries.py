"""One registered query per operator, and the SQL that DuckDB can check."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, embed, html, langid, line_dedup, minhash, mixing, negatives, packing, pii, quality, secrets
from .common import read_table


def vocabulary(name: str) -> str:
    """A public tokenizer file; ``MARTLET_TOKENIZERS`` names another folder."""
    folder = os.environ.get("MARTLET_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_digest(docs, vocabulary("word_bpe_49k.json")).select("doc_id", "bpe.*")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"),
                        F.char_length("main_text").cast("long").alias("n_chars"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
                      F.sha2(F.col("line_dedup.kept").cast("binary"), 256).alias("kept_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.identify(docs.select("doc_id", "text"), train_on=docs)
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_id.lang_pred", "lang_id.score")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, width=2, percent=80)


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymise(docs, key=os.environ.get("MARTLET_PII_KEY", "martlet"))
    return out.select("doc_id", F.size("pii.found").cast("long").alias("n_pii"), F.concat_ws(
        ",", F.transform("pii.found", lambda x: F.concat_ws(":", x.kind, x.new))).alias("pseudonyms"),
        F.col("pii.text").alias("text"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality.passes("base-1")).alias("base_failed"),
                       (quality.passes("base-1") & quality.passes("standard-1")).alias("kept"), "failed_bits")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), 0.93)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def n(kind: str):  # noqa: ANN202
        return F.size(F.filter("base", lambda r: r.k == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return rows.select("row.doc_id", n("assign"), n("access"), n("hex"),
                       F.sha2(secrets.render(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                       secrets.render(F.sort_array(F.concat("base", "added"))).alias("spans"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                        {"<|endoftext|>": 50256})


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read_table(spark, sf_dir, "embeddings"), anchor_every=100, shift_every=7)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = alignment.align(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          vocabulary("piece_bpe_32k.model"), keep_text=False)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "alignment.*")


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixing.mix(docs, keep_text=False)
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_bpe_tokens, op2_main_text, op3_line_dedup, op4_language_id, op5_near_duplicates, op6_pii_pseudonyms,
        op7_quality_rules, op8_embedding_dedup, op9_secret_scan, op10_packing,
        op11_hard_negatives, op12_token_alignment, op13_source_mix, pipeline)}


def oracle_sql() -> dict[str, str]:
    from .sql import ORACLES

    return dict(ORACLES)
