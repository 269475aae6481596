"""The corpus pipeline: language ID, line dedup, near-dedup, secret redaction,
packing.  Each stage reads all that its predecessor kept, is written as Parquet
and read again; all but the last return the columns of ``documents``.

Defined cases, for every stage: null text counts as empty (language ID drops texts
without a letter, so later stages see none of them); rows that repeat id and text are
one document and share each decision, rows that repeat an id only are documents of
their own; other columns, whatever their names, come out as they went in; an empty
table gives an empty result; texts are read whole whatever their length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import langid, line_dedup, minhash, packing, queries, secrets
from martlet.llm.common import read_table, store


def _with_text(docs: DataFrame, made: DataFrame, row: Column, text: Column) -> DataFrame:
    """The columns of ``docs`` from ``row``, with a new text and its length."""
    return made.select(*[
        text.alias("text") if c == "text"
        else F.char_length(text).cast("long").alias(c) if c == "n_chars" else row[c].alias(c)
        for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose language is not recognised: no letter, or n-grams that the
    best learned language explains no better than a uniform background.  Keeps all
    when no row has a label to learn from."""
    fit = langid.identify(docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    return fit.where(F.isnan("lang_id.fit") | F.coalesce(F.col("lang_id.fit") > 0, F.lit(True))).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines found in ten documents or more; every document stays."""
    rows = line_dedup.dedup_lines(docs)
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("line_dedup.kept").alias("new"))
    return _with_text(docs, whole, F.col("row"), F.col("new"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles,
    similarity 0.8).  A decision holds for an id and text, not for an id alone."""
    tag = F.xxhash64("text")
    gone = (minhash.near_duplicates(docs.select("doc_id", "text"), tag=tag).where("not kept")
            .select(F.col("doc_id").alias("gone_id"), F.col("tag").alias("gone_tag")).distinct().alias("gone"))
    return docs.alias("docs").join(
        gone, (F.col("docs.doc_id").cast("long") == F.col("gone.gone_id")) & (F.xxhash64("docs.text") == F.col("gone.gone_tag")),
        "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; every document stays."""
    found = secrets.scan(docs).select("row", F.sort_array(F.concat("base", "added")).alias("spans"))
    text = F.col("row")["text"]
    clean = F.when(F.size("spans") > 0, secrets.redact(text, F.col("spans"))).otherwise(text)
    return _with_text(docs, found.withColumn("new", clean), F.col("row"), F.col("new"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; one row per piece."""
    import public_tokenizers

    return packing.pack(docs, queries.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                        {"<|endoftext|>": 50256})


STAGES = [("language_id", language_stage), ("line_dedup", line_stage), ("near_duplicates", near_duplicate_stage),
          ("secrets", secret_stage), ("packing", packing_stage)]
#: SQL cannot tokenise or score languages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
