"""Corpus pipeline: five operators in turn over ``documents``.

Null and empty texts are clean, have no lines to remove, are near copies of each other
(one stays), hold no passage and have no ids. Rows that repeat are one document for the
near-copy stage. Extra columns stay, whatever their names; an empty table gives an empty
one. All but the last stage return the columns of their input.
"""

from pyspark.sql import functions as F

from skylag.llm import decontam, line_dedup, pieces, queries, simhash, toxicity
from skylag.llm.common import scratch, shared_uri


def drop_toxic(spark, docs, sf_dir):
    """Documents that score below one half stay."""
    return toxicity.drop_toxic(docs, queries.table(spark, sf_dir, "labels"))


def dedup_lines(spark, docs, sf_dir):
    """Every document stays, without lines that repeat an earlier one; ``n_chars`` is counted
    again where the table has it."""
    left = line_dedup.dedup_lines(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else left


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents without a passage of the benchmark stay."""
    return decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def encode_pieces(spark, docs, sf_dir):
    """Ids of every text, with the check that they decode to it."""
    return pieces.round_trip(docs, queries.PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

# SimHash, likelihoods and shortest paths are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, each written and read again; a stage's own tables go when it is written."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        uri = shared_uri(spark, f"stage-{name.replace(' ', '-')}")
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(uri)
        docs = spark.read.parquet(uri)
    return STAGES[-1][1](spark, docs, sf_dir)
