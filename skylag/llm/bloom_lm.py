"""Language-model scores from a log-frequency Bloom filter.

Training words and word pairs are counted. A count c has level 1 + floor(log2 c), and
the filter holds the pairs (n-gram, 1) .. (n-gram, level). A count is read back by
probing level after level until one is missing: the answer is never too low, and too
high by one level as often as the filter errs. A word's probability interpolates its
pair's relative frequency with its own.

The filter grows with the n-grams, at ``BITS`` bits for each member, so it errs alike
at every size. It is made in slices of the hash space, each by one task, and stays
there: the n-grams of all documents go to the slices and their levels come back, so
that documents are read twice at any size, once to count tokens and once for the rest,
and no process holds more than one slice.

Documents are worked on in blocks of about ``GATHER`` tokens. A block sends each of its
words and pairs once, to its slice, with its count in training documents; its texts
travel beside as numbers of its words, and meet the answers by the block's name.
Slices also answer words' exact counts, so the base score is exact. Words stand for
themselves by 64-bit hashes.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import LOWER, stored

HOT_WORDS = 1 << 20
BITS = 8
PROBES = 4
FILTER_BYTES = 256 << 20
# Tokens for one slice of pairs, tokens of a block, words a worker keeps from one block to the next.
SLICE_GRAMS = 1 << 19
GATHER = 1 << 20
KEPT_WORDS = 200_000
# Slices of pairs for one of words.
WORD_SHARE = 8
# Share of the pair's relative frequency in a word's probability.
PAIR_SHARE = 0.7
# The end of a text, and the start of the next: no word, as words hold no white space.
END = b"\n"

# Rows of these kinds: a block's documents, and its words and its pairs in one slice.
BLOCK, WORDS, PAIRS = 0, 1, 2
GRAM_SCHEMA = "kind int, key long, block long, a binary, b binary, c binary"
ANSWER_SCHEMA = "kind int, key long, block long, distinct long, a binary, b binary, levels binary, counts binary"
SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is never learned from; a null id is not either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(True))


def mixed(h):
    """A hash of hashes, elementwise."""
    import numpy as np

    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def unmixed(h):
    """The hashes that ``mixed`` was given."""
    import numpy as np

    back = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    h = (h ^ (h >> np.uint64(32))) * back
    h = (h ^ (h >> np.uint64(32))) * back
    return h ^ (h >> np.uint64(32))


def pair_hash(first, second):
    import numpy as np

    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))))


class Numbers(dict):
    """Numbers words in the order seen; ``new`` are those without a hash yet."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        number = self[word] = len(self)
        return number


class Words:
    """Numbers of words, with their hashes."""

    def __init__(self):
        self.clear()

    def clear(self):
        import numpy as np

        self.number, self.hashes = Numbers(), np.zeros(0, dtype=np.uint64)

    def read(self, texts: list[bytes]):
        """Numbers of all tokens of the texts, and each text's number of tokens. New words get hashes."""
        import numpy as np
        import xxhash

        number, parts, sizes = self.number, [], []
        for text in texts:
            words = text.translate(LOWER).split()
            words.append(END)
            parts.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
            sizes.append(len(words))
        if number.new:
            more = np.array([xxhash.xxh64_intdigest(w) for w in number.new], dtype=np.uint64)
            self.hashes = np.concatenate([self.hashes, more])
            number.new.clear()
        return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)), np.array(sizes, dtype=np.int64)


def slice_of(h, slices: int):
    """The slice of each hash: equal parts of the range of hashes, in order."""
    import numpy as np

    return (((h >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)).astype(np.int64)


def contexts(numbers, sizes, end: int):
    """The number before each token; a text begins after an end."""
    import numpy as np

    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = end
    return before


def batches_of(batch, size: int = 1 << 20):
    """Slices of a batch of about ``size`` characters, at least a row each."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    begin, total = 0, 0
    for k, n in enumerate(lengths):
        total += n
        if total >= size or k == len(lengths) - 1:
            yield batch.slice(begin, k + 1 - begin)
            begin, total = k + 1, 0


# ---- n-grams of blocks


def count_tokens(training: DataFrame) -> int:
    """Tokens of all texts, ends included."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            total = batch.num_rows + sum(len(t.split()) for t in batch.column(0).to_pylist() if t)
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["tokens"])

    return training.select("text").mapInArrow(run, "tokens long").agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]


def block_pairs(hashes, numbers, sizes):
    """A block's pairs: the number before each token, the tokens ordered by their pair, the
    pairs' hashes in that order, and where a new pair begins.

    Ordered by all high bits of the hash that leave room for a token's place: of pairs that
    differ in lower bits only, one may appear twice, which is counted and answered as well.
    """
    import numpy as np

    before = contexts(numbers, sizes, numbers[sizes[0] - 1])
    pairs = pair_hash(hashes[before], hashes[numbers])
    low = np.uint64(len(pairs).bit_length())
    order = np.sort((pairs >> low << low) | np.arange(len(pairs), dtype=np.uint64))
    order = (order & ((np.uint64(1) << low) - np.uint64(1))).view(np.int64)
    pairs = pairs[order]
    return before, order, pairs, np.concatenate([[True], pairs[1:] != pairs[:-1]])


def _packed(numbers) -> bytes:
    """Numbers below 2^32, place by place, compressed."""
    import numpy as np
    import pyarrow as pa

    planes = np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes, count: int):
    import numpy as np
    import pyarrow as pa

    planes = pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True)
    numbers = np.ascontiguousarray(np.frombuffer(planes, dtype="u1").reshape(4, -1).T).view("<u4")
    return numbers.ravel().astype(np.int64)


def _cut(values, begin):
    """Rows of bytes: the values from each beginning to the next."""
    import numpy as np
    import pyarrow as pa

    ends = (np.append(begin, len(values)) * values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)).astype("<i4")
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(begin), buffers)


def _joined(column, dtype: str):
    """Values of all rows of bytes one after the other, and the bytes of each row."""
    import numpy as np
    import pyarrow.compute as pc

    parts = [np.zeros(0, dtype="u1")]
    for chunk in column.chunks:
        _, offsets, data = chunk.buffers()
        wide = "<i8" if str(chunk.type).startswith("large") else "<i4"
        ends = np.frombuffer(offsets, dtype=wide)[chunk.offset:chunk.offset + len(chunk) + 1] if len(chunk) else [0]
        if ends[-1] > ends[0]:
            parts.append(np.frombuffer(data, dtype="u1")[ends[0]:ends[-1]])
    lengths = pc.binary_length(column).to_numpy().astype(np.int64)
    return np.concatenate(parts).view(dtype), lengths


def _gram_rows(kind: int, block: int, hashes, counts, slices: int):
    """Hashes in the order of their slices, with counts: a row for each slice that has some.

    A hash is its step from the one before: six low bytes, and two high ones that are mostly zero.
    """
    import numpy as np
    import pyarrow as pa

    own = slice_of(hashes, slices)
    begin = np.flatnonzero(np.diff(own, prepend=-1))
    steps = np.diff(hashes, prepend=np.uint64(0))
    steps[begin] = hashes[begin]
    places = steps.astype("<u8").view("u1").reshape(-1, 8)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(begin), kind, dtype=np.int32)), pa.array(own[begin]),
        pa.array(np.full(len(begin), block, dtype=np.int64)),
        _cut(places[:, :6], begin), _cut(places[:, 6:], begin), _cut(counts.astype("<u4"), begin),
    ], ["kind", "key", "block", "a", "b", "c"])


def _hashes_of(table):
    """The hashes of rows of n-grams, and where each row's begin."""
    import numpy as np

    low, lengths = _joined(table.column("a"), "u1")
    sizes = lengths // 6
    begin = np.cumsum(sizes) - sizes
    places = np.empty((len(low) // 6, 8), dtype="u1")
    places[:, :6] = low.reshape(-1, 6)
    places[:, 6:] = _joined(table.column("b"), "u1")[0].reshape(-1, 2)
    steps = places.view("<u8").ravel()
    hashes = np.cumsum(steps, dtype=np.uint64)
    return hashes - np.repeat(hashes[begin] - steps[begin], sizes), begin


def _block_rows(documents, numbers, sizes, all_hashes, place_in_run: int, slices: dict):
    """A block's documents, words and pairs. ``numbers`` are places in ``all_hashes``."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    used = np.flatnonzero(np.bincount(numbers, minlength=len(all_hashes)))
    used = used[np.argsort(mixed(all_hashes[used]))]
    hashes, place = all_hashes[used], np.zeros(len(all_hashes), dtype=np.int64)
    place[used] = np.arange(len(used))
    numbers = place[numbers]
    learned = np.repeat(~documents.column("held_out").to_numpy(), sizes)
    documents = documents.append_column("n_tokens", pa.array(sizes))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as stream:
        stream.write_table(documents)
    held = [sink.getvalue().to_pybytes(), _packed(numbers), b""]
    # Named by what it holds, so that a task that runs again gives the same name to the same block.
    name = xxhash.xxh64(place_in_run.to_bytes(8, "little"))
    for part in (*held, hashes.tobytes()):
        name.update(part)
    block = int(np.uint64(name.intdigest()).view(np.int64))
    # Some slice of pairs takes it along, so that all tasks there have alike to do.
    yield pa.RecordBatch.from_arrays(
        [pa.array([BLOCK], pa.int32()), pa.array([block % slices[PAIRS]], pa.int64()), pa.array([block], pa.int64()),
         *[pa.array([part], pa.binary()) for part in held]], ["kind", "key", "block", "a", "b", "c"])
    counts = np.bincount(numbers[learned], minlength=len(hashes))
    yield _gram_rows(WORDS, block, mixed(hashes), counts, slices[WORDS])
    _, order, pairs, new = block_pairs(hashes, numbers, sizes)
    counts = np.add.reduceat(learned[order].astype(np.int64), np.flatnonzero(new))
    yield _gram_rows(PAIRS, block, pairs[new], counts, slices[PAIRS])


def gram_rows(documents: DataFrame, slices: dict) -> DataFrame:
    """Documents of blocks, and their n-grams by slice, as in ``GRAM_SCHEMA``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        words, pieces, numbers, sizes, size = Words(), [], [], [], 0
        task, blocks = TaskContext.get().partitionId(), 0

        def block():
            return _block_rows(
                pa.Table.from_batches(pieces), np.concatenate(numbers), np.concatenate(sizes), words.hashes,
                (task << 32) + blocks, slices,
            )

        for batch in batches:
            for piece in batches_of(batch):
                n, s = words.read([t or b"" for t in piece.column("text").to_pylist()])
                pieces.append(piece.select(["doc_id", "held_out"]))
                numbers.append(n)
                sizes.append(s)
                size += len(n)
                if size >= GATHER:
                    yield from block()
                    blocks += 1
                    pieces, numbers, sizes, size = [], [], [], 0
                    if len(words.number) > KEPT_WORDS:
                        words.clear()
        if size:
            yield from block()

    return documents.select("doc_id", "held_out", "text").mapInArrow(run, GRAM_SCHEMA)


# ---- the filter


class Filter:
    """Slices of one filter: bits, and for each kind and slice where they lie."""

    def __init__(self, bits, places: dict, slices: dict):
        import numpy as np

        self.bits, self.slices = bits, slices
        self.starts, self.sizes = {}, {}
        for kind, n in slices.items():
            at = [places.get((kind, s), (0, 0)) for s in range(n)]
            self.starts[kind] = np.array([a for a, _ in at], dtype=np.uint64)
            self.sizes[kind] = np.array([m for _, m in at], dtype=np.uint64)

    def level(self, kind: int, h):
        """The largest level up to which all are members; 0 for an n-gram never seen."""
        import numpy as np

        found = np.zeros(len(h), dtype=np.int64)
        n = self.slices.get(kind, 0)
        if not n or not len(h):
            return found
        own = slice_of(h, n)
        start, size = self.starts[kind][own], self.sizes[kind][own]
        first, step = strides(h)
        alive = np.flatnonzero(size > 0)
        level = 0
        while len(alive):
            level += 1
            there = np.ones(len(alive), dtype=np.uint8)
            begin = start[alive]
            for place in places_of(first[alive], step[alive], level, size[alive]):
                place += begin
                there &= self.bits[(place >> np.uint64(3)).view(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)
            alive = alive[(there & 1) > 0]
            found[alive] = level
        return found


def places_of(start, step, level: int, size):
    """The bits of members ``(n-gram, level)`` in slices of ``size`` bits, one after the other."""
    import numpy as np

    for k in range(PROBES):
        at = start + np.uint64(level * PROBES + k) * step
        yield ((at >> np.uint64(32)) * size) >> np.uint64(32)


def strides(h):
    """Where the places of an n-gram begin, and the step from one to the next."""
    import numpy as np

    start = mixed(h)
    return start, (start * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def expected(level):
    """The count that a level stands for: the middle of 2^(level-1) .. 2^level - 1, and 0 for 0."""
    import numpy as np

    return np.where(level > 0, (3 * 2.0 ** (level - 1) - 1) / 2, 0.0)


def filter_slice(kind: int, hashes, counts) -> Filter:
    """The slice that holds distinct hashes with their counts: levels taken, bits set."""
    import numpy as np

    top = np.frexp(counts.astype(np.float64))[1]
    size = -(-int(top.sum()) * BITS // 64) * 64
    bits = np.zeros(size, dtype=bool)
    first, step = strides(hashes)
    for level in range(1, int(top.max(initial=0)) + 1):
        enough = top >= level
        first, step, top = first[enough], step[enough], top[enough]
        for place in places_of(first, step, level, np.uint64(size)):
            bits[place.view(np.int64)] = True
    return Filter(np.packbits(bits, bitorder="little"), {(kind, 0): (0, size)}, {kind: 1})


def answers(grams: DataFrame) -> DataFrame:
    """Rows of blocks as they are; of n-grams the ``levels`` read from their slice of the filter. Words
    come with their hashes and ``counts``, and on one row of a slice with the number of those that are ``distinct``."""

    def rows(table, a, b, levels, counts, distinct: int = 0):
        import numpy as np
        import pyarrow as pa

        words = np.zeros(len(table), dtype=np.int64)
        words[:1] = distinct
        return pa.table(
            [*(table.column(c) for c in ("kind", "key", "block")), pa.array(words), a, b, levels, counts],
            ["kind", "key", "block", "distinct", "a", "b", "levels", "counts"])

    def run(table):
        import numpy as np
        import pyarrow as pa

        blocks = table.column("kind").to_numpy() == BLOCK
        own, table = table.filter(pa.array(blocks)), table.filter(pa.array(~blocks))
        none = pa.array([b""] * len(own), pa.binary())
        own = rows(own, own.column("a"), own.column("b"), none, none)
        if not len(table):
            return own
        kind = table.column("kind")[0].as_py()
        hashes, begin = _hashes_of(table)
        hashes, at = np.unique(hashes, return_inverse=True)
        total = np.bincount(at, _joined(table.column("c"), "<u4")[0], len(hashes)).astype(np.int64)
        levels = _cut(filter_slice(kind, hashes, total).level(kind, hashes).astype("u1")[at], begin)
        none = pa.array([b""] * len(table), pa.binary())
        if kind == PAIRS:
            return pa.concat_tables([own, rows(table, none, none, levels, none)])
        exact = _cut(total[at].astype("<i8"), begin)
        return pa.concat_tables([own, rows(table, table.column("a"), table.column("b"), levels, exact, np.count_nonzero(total))])

    return grams.groupBy((F.col("kind") == WORDS).alias("words"), "key").applyInArrow(run, ANSWER_SCHEMA)


# ---- scoring

UNLIKE = "a block and its answers do not match: the documents changed while they were read"


def block_scores(answered: DataFrame, tokens: int, smooth: float) -> DataFrame:
    """The scores of each block's documents, from the answers of all slices."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        kind = table.column("kind").to_numpy()
        key = table.column("key").to_numpy()

        def rows(of: int):
            own = np.flatnonzero(kind == of)
            return table.take(pa.array(own[np.argsort(key[own])]))

        held, words = rows(BLOCK), rows(WORDS)
        if len(held) != 1:
            raise ValueError(UNLIKE)
        documents = pa.ipc.open_stream(held.column("a")[0].as_py()).read_all()
        sizes = documents.column("n_tokens").to_numpy()
        numbers = _unpacked(held.column("b")[0].as_py(), int(sizes.sum()))
        hashes = unmixed(_hashes_of(words)[0])
        if len(hashes) != numbers.max() + 1:
            raise ValueError(UNLIKE)
        before, order, _, new = block_pairs(hashes, numbers, sizes)
        own = expected(_joined(words.column("levels"), "u1")[0].astype(np.int64))
        exact, _ = _joined(words.column("counts"), "<i8")
        pairs = expected(_joined(rows(PAIRS).column("levels"), "u1")[0].astype(np.int64))
        lead = order[new]
        if len(pairs) != len(lead):
            raise ValueError(UNLIKE)
        context = np.maximum(own[before[lead]], pairs)
        share = np.where(context > 0, PAIR_SHARE, 0.0)
        p = share * pairs / np.maximum(context, 1) + (1 - share) * ((own + 1) / smooth)[numbers[lead]]
        pair = np.empty(len(order), dtype=np.int64)
        pair[order] = np.cumsum(new) - 1
        owner = np.repeat(np.arange(len(sizes)), sizes)
        base = np.bincount(owner, np.log10(exact + 1.0)[numbers], len(sizes))
        return pa.table({
            "doc_id": documents.column("doc_id"), "held_out": documents.column("held_out"), "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.bincount(owner, (exact > 0)[numbers], len(sizes)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(sizes), tokens, dtype=np.int64)),
            "base_score": pa.array(base - sizes * np.log10(smooth)),
            "score": pa.array(np.bincount(owner, np.log10(p)[pair], len(sizes))),
        })

    return answered.groupBy("block").applyInArrow(run, SCORE_SCHEMA)


def lm_scores(
    documents: DataFrame, hot: int = HOT_WORDS, filter_bytes: int = FILTER_BYTES, slice_grams: int = SLICE_GRAMS
) -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learned from the documents that are not held out (a null doc_id is). A null text is
    empty and has its end as only token. Repeated rows count and score each by itself.
    Without training documents counts are 0 and probabilities those of one unseen word.

    A slice of the filter has about ``slice_grams`` tokens, and ``filter_bytes`` at most. ``hot`` has no effect:
    frequent words are answered by the slices as all others are.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), held_out().alias("held_out")
    )
    tokens = count_tokens(rows.where("NOT held_out"))
    # At most one pair a token, two members on average. Words are fewer; most come from many blocks.
    pairs = max(1, tokens // slice_grams, -(-tokens * 2 * BITS // 8 // filter_bytes))
    slices = {PAIRS: pairs, WORDS: -(-pairs // WORD_SHARE)}
    answered = stored(answers(gram_rows(rows, slices)), "lm-answers")
    distinct = answered.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    return block_scores(answered, tokens, float(tokens + distinct + 1))
