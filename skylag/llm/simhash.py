"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has two halves of 32 bits. If two fingerprints differ in at most four
bits, one half differs in at most two. The anchors of a half are the words of the
Hamming code of length 31 (the last bit of the half is left out): every 31-bit word
is within covering radius 1 of exactly one anchor. Each fingerprint goes to every
anchor of its halves within radius 1 plus the threshold of one bit on its side: the
word halfway between two halves that differ in two bits is one bit away from both
and at most one from its anchor, so both reach that anchor. (A radius of 1 plus both
bits is needed only if one of the two sides stays at its nearest anchor.) That is
16 anchors a half, or one for code words. Fingerprints are compared per anchor.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import LOWER, near_components, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
CODE_BITS = 31
# Shingles whose bits are counted at a time.
BLOCK = 1 << 14


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64 majority bits of the shingle hashes, as a signed number; 0 without words."""
    import numpy as np
    import xxhash

    words = [] if text is None else text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        hashes = [hashed(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        span = zip(starts[:len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1:].tolist())
        hashes = [hashed(joined[a:b], SEED) for a, b in span]
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = np.array(hashes[at:at + BLOCK], dtype="<u8").view("u1").reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = (votes * 2 > len(hashes)).astype("u1")
    return int(np.packbits(set_, bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp, text_hash`` of every document; a null text has no words. Other columns are ignored."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1)
            fps = [fingerprint(texts[k].as_py(), shingle_words) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64()), batch.column(2)], ["doc_id", "fp", "text_hash"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, fp long, text_hash long")


def anchors_of(fps):
    """For an array of fingerprints: the anchors, and the index of the fingerprint of each.

    The bits of a word at places 1 to 31 have a syndrome, the xor of their places. The
    code words are those with syndrome 0; an error pattern leads from a word to a code
    word if its own syndrome is the word's. Patterns of at most two bits are one place
    equal to the syndrome, or two places whose xor it is.
    """
    import numpy as np

    places = np.arange(1, CODE_BITS + 1, dtype=np.int64)
    words = fps.view(np.uint64)
    anchors, owners = [], []
    for half in range(2):
        code = ((words >> np.uint64(32 * half)) & np.uint64((1 << CODE_BITS) - 1)).astype(np.int64)
        syndrome = np.zeros(len(code), dtype=np.int64)
        for place in places.tolist():
            syndrome ^= np.where((code >> (place - 1)) & 1, place, 0)
        nearest = np.where(syndrome > 0, code ^ (np.int64(1) << np.maximum(syndrome - 1, 0)), code)
        anchors.append(nearest | (half << CODE_BITS))
        owners.append(np.arange(len(code)))
        other = places[None, :] ^ syndrome[:, None]
        row, col = np.nonzero((syndrome[:, None] > 0) & (other > places[None, :]))
        pattern = (np.int64(1) << (places[col] - 1)) | (np.int64(1) << (other[row, col] - 1))
        anchors.append((code[row] ^ pattern) | (half << CODE_BITS))
        owners.append(row)
    return np.concatenate(anchors), np.concatenate(owners)


def anchor_rows(distinct: DataFrame) -> DataFrame:
    """``bucket, node`` for every anchor that a fingerprint reaches."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fps), 4096):
                part = fps[at:at + 4096]
                anchors, owners = anchors_of(part)
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(part[owners])], ["bucket", "node"])

    return distinct.select("fp").mapInArrow(run, "bucket long, node long")


def simhash_groups(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` per document: components of the links between
    fingerprints that differ in at most ``max_bits`` bits (at most 4).

    component_id is the smallest doc_id of the component, null if all are null. Equal
    fingerprints are one node, so copies make neither anchors nor pairs; documents
    without words share fingerprint zero. Repeated rows are each answered. The join
    of documents with their fingerprint's component can be split at a hot fingerprint.
    """
    return _grouped(documents, shingle_words, max_bits).select("doc_id", "fp", "component_id")


def _grouped(documents: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """``doc_id, fp, text_hash, root, component_id``; root tells components without any doc_id apart."""
    if max_bits > 4:
        raise ValueError("anchors cover at most 4 differing bits")
    rows = stored(fingerprints(documents, shingle_words), "simhash-rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    groups = near_components(
        anchor_rows(distinct).withColumn("mark", F.col("node")),
        lambda nodes: lambda pairs: pairs.where(f"bit_count(a ^ b) <= {max_bits}"),
        f"bit_count(x ^ y) > {max_bits}", "simhash",
    )
    member = distinct.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = member.groupBy("root", F.pmod("root", F.lit(7)).alias("part")).agg(
        F.min("first_id").alias("component_id")
    ).select(F.col("root").alias("of_root"), "component_id")
    labels = stored(
        member.join(least, F.col("root") == F.col("of_root")).select(F.col("fp").alias("of_fp"), "root", "component_id"),
        "simhash-labels",
    )
    return rows.join(labels, F.col("fp") == F.col("of_fp")).select("doc_id", "fp", "text_hash", "root", "component_id")


def drop_near_copies(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, that with the smallest doc_id, with all its columns.

    A document is a doc_id with a text; rows that repeat both count as one, and one of
    them stays. Texts that share a doc_id, or have none, are documents of their own: each
    group keeps that with the smallest doc_id, null last, and then the smallest text hash.
    """
    groups = _grouped(documents, shingle_words, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    keep = groups.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash")
    )
    # The row as one column, so that none of its names can clash.
    rows = documents.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"), F.xxhash64("text").alias("row_hash")
    )
    same = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash"))
    return rows.join(keep, same, "left_semi").dropDuplicates(["row_id", "row_hash"]).select("row.*")
