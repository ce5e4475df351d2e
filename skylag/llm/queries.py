"""The registered queries of the operators, with production parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm import (
    alignment, ann, bloom_lm, decontam, line_dedup, ngram_join, pieces, simhash, suffix_dedup, token_files, toxicity, warc,
    whitening,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op2_toxicity(spark, sf_dir):
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "sentences")


def op3_token_files(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"), TOKENIZER, END_ID)


def op4_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op5_bloom_lm(spark, sf_dir):
    return bloom_lm.lm_scores(table(spark, sf_dir, "documents"))


def op6_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op7_simhash(spark, sf_dir):
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op9_decontaminate(spark, sf_dir):
    found = decontam.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["b"] - h["a"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op10_pieces(spark, sf_dir):
    return pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)


def op11_alignment(spark, sf_dir):
    return alignment.alignment_report(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)


def op12_ngram_join(spark, sf_dir):
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    import corpus_pipeline

    own = [
        op1_warc, op2_toxicity, op3_token_files, op4_line_dedup, op5_bloom_lm, op6_nearest, op7_simhash,
        op8_suffix_dedup, op9_decontaminate, op10_pieces, op11_alignment, op12_ngram_join, op13_whitening,
    ]
    return {q.__name__: q for q in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    from skylag.llm import oracle

    return oracle.oracle_sql()
