"""What workers hold at a time, and shuffle files that a stored table leaves."""

import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skylag.llm import pieces, queries, token_files, toxicity
from skylag.llm.common import SLICE_BYTES, give_back, slices, stored


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """They stayed until the driver collected garbage, and counted as disk."""
    before = shuffle_files(spark)
    keys = spark.range(10_000).selectExpr("id % 100 AS k", "id")
    table = stored(keys.groupBy("k").agg(F.sum("id").alias("s")).join(keys.repartition(4, "k"), "k"), "stored-test")
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and table.count() == 10_000
    # The setting is the session's own again.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_slices_keep_rows_and_order():
    batch = pa.RecordBatch.from_pydict({"n": list(range(1000)), "text": ["x" * 20_000] * 999 + [None]})
    parts = list(slices([batch, batch.slice(0, 0)]))
    assert len(parts) > 1 and max(p.nbytes for p in parts) < 2 * SLICE_BYTES
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


@pytest.mark.parametrize("name", ["pieces", "toxicity"])
def test_large_batches_are_not_made_at_once(spark, monkeypatch, name):
    """A batch of 10,000 texts came out as one: ids of 42 MB, held three times by each worker."""
    docs = spark.createDataFrame([(0, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    if name == "pieces":
        run = pieces.round_trip(docs, queries.PIECES)
    else:
        monkeypatch.setattr(toxicity, "fit_sample", lambda *_: (-5.0, {}))
        run = toxicity.drop_toxic(docs, docs)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(4000)), "text": ["word and more, " * 300] * 4000})
    made = list(run([batch]))
    assert sum(m.num_rows for m in made) == 4000 and max(m.nbytes for m in made) < 4 * SLICE_BYTES


def test_frequent_words_stay(monkeypatch):
    """All kept words were dropped at once, the frequent ones too."""
    monkeypatch.setattr(token_files, "KEPT_WORDS", 10)
    encoder, learned = token_files.WordEncoder(queries.TOKENIZER, "<u2"), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: learned.extend(words) or learn(words))
    for k in range(60):
        text = f"hello wörld{k}x, hello 日本{k}."
        assert encoder.encode([text]) == [encoder._bytes(encoder.ids(text))]
    assert learned.count(b"hello") == 1 and len(encoder.older) < 30


def test_texts_are_taken_by_number_and_length():
    texts = pa.array([None, "", *(["ab"] * 5), "x" * 50, "y"])
    own = list(token_files.taken(texts, most=3, chars=20))
    assert [t for part in own for t in part] == ["", "", *(["ab"] * 5), "x" * 50, "y"]
    assert [len(part) for part in own] == [3, 3, 2, 1]


def test_memory_is_given_back():
    """A process that read and fitted a sample kept 124 MB of which nothing was in use."""
    def held():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon:"))

    own = [bytearray(60_000) for _ in range(3000)]
    last = own.pop()
    del own
    before = held()
    give_back()
    assert held() < before - 100_000 and len(last) == 60_000
