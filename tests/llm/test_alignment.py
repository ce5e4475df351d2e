"""Alignment of two tokenizers against loops over all token pairs."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from skylag.llm import alignment
from skylag.llm.queries import BYTE_LEVEL, PIECES

TEXTS = [
    None, "", " ", "one", "Hello, world! Hello, world!", "a ▁ b", "日本語のテキスト 🎉🎊 done", "<s> </s><|endoftext|> <unk>",
    "\x00\x01\ttab\r\nline\n\n\n  spaces", "naïve café " * 30, "x" * 700, "Hello, world! Hello, world!", "don't we'll it's 12345 a1b2",
]
SCHEMA = "doc_id long, text string, block long, pairs string, a int, run string, links int"


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def tokens(text):
    """Ids and bytes of both sides, or None."""
    tok = Tokenizer.from_file(BYTE_LEVEL)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = alignment.byte_letters()
    if not text:
        return None
    a = tok.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)
    bytes_a = [bytes(letters[c] for c in tok.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a, b, spans(bytes_a), spans(bytes_b)) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None


def brute(texts):
    docs, counts = [], Counter()
    for text in texts:
        if (found := tokens(text)) is None:
            docs.append(None)
            continue
        a, b, sa, sb = found
        links = [(a[i], b[j]) for i, (p, q) in enumerate(sa) for j, (r, s) in enumerate(sb) if p < s and r < q]
        cuts = sorted({q for _, q in sa} & {q for _, q in sb})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            own = [[str(x[i]) for i, (p, _) in enumerate(s) if low <= p < high] for x, s in ((a, sa), (b, sb))]
            groups.append(own)
        written = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        docs.append((len(a), len(b), groups, links, hashlib.sha256(written.encode()).hexdigest()))
        counts.update(links)
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (0,) * 7 + ("",) if d is None else (
            d[0], d[1], len(d[2]), len(d[3]), sum(counts[p] == top[p[1]] for p in d[3]), sum(counts[p] for p in d[3]),
            sum(len(x) * len(y) for x, y in d[2]), d[4],
        ) for d in docs
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "x", 2, "y", 3) for i, t in enumerate(TEXTS)] + [(None, "one", 1, "x", 2, "y", 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("entries, product, chunk", [(1 << 20, 1 << 21, 1 << 20), (40, 50, 64)])
def test_report(docs, monkeypatch, entries, product, chunk):
    """Also with documents that span several blocks, and products in several blocks of rows."""
    monkeypatch.setattr(alignment, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(alignment, "PRODUCT", product)
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.alignment_report(docs, BYTE_LEVEL, PIECES).collect()}
    want = brute([*TEXTS, "one"])
    assert got == dict(zip([*range(len(TEXTS)), None], want))
    assert got[5] == got[0] == got[1] and got[6][0] > 0


def test_repeated_rows_and_empty_table(docs):
    twice = docs.where("doc_id = 4").union(docs.where("doc_id = 4"))
    rows = alignment.alignment_report(twice, BYTE_LEVEL, PIECES).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert alignment.alignment_report(docs.where("false"), BYTE_LEVEL, PIECES).count() == 0


@pytest.mark.parametrize("shared", [False, True])
def test_links(docs, shared):
    got = Counter((r.doc_id, r.a, r.b, r.n_bytes) for r in alignment.token_links(docs, BYTE_LEVEL, PIECES, shared).collect())
    want = Counter()
    for doc_id, text in [*enumerate(TEXTS), (None, "one")]:
        if (found := tokens(text)) is None:
            continue
        _, _, sa, sb = found
        cuts = sorted({q for _, q in sa} & {q for _, q in sb})
        group = [[sum(c <= p for c in cuts) for p, _ in s] for s in (sa, sb)]
        for i, (p, q) in enumerate(sa):
            for j, (r, s) in enumerate(sb):
                common = min(q, s) - max(p, r)
                if shared and group[0][i] == group[1][j]:
                    want[doc_id, i, j, None] += 1
                elif not shared and common > 0:
                    want[doc_id, i, j, common] += 1
    assert got == want


def test_long_text(spark):
    """More than one product block and one entry block for a single text."""
    text = "The quick brown fox, jumping over 12 lazy dogs. " * 40_000
    frame = spark.createDataFrame([(1, text), (2, text[:48])], "doc_id long, text string")
    long_, short = sorted(alignment.alignment_report(frame, BYTE_LEVEL, PIECES).collect(), key=lambda r: r.doc_id)
    assert long_.n_links > 40_000 * (short.n_links - 4) and long_.n_links < 40_000 * (short.n_links + 4)
    assert long_.count_sum > long_.n_links * 1000


def test_ids_of_every_code_point():
    """Side A has the ids of the tokenizers library, also for rare characters and in their neighbourhood."""
    pair = alignment.Pair(BYTE_LEVEL, PIECES)
    tok = Tokenizer.from_file(BYTE_LEVEL)
    tok.encode_special_tokens = True
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        texts = [f" a{c}1{c}.{c}'s  {c}" for c in points[at:at + 50_000]]
        want = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        assert [pair.a.encode_ordinary(t) for t in texts] == want


def test_product_adds_up():
    """Gustavson's products against a dense matrix, with rows and columns in any order."""
    import numpy as np

    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 2, (7, 9)), rng.integers(0, 2, (5, 9))

    def rows(m):
        return np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1]

    got = np.zeros((7, 5), dtype=int)
    for i, j, n in alignment.row_products(rows(a), alignment.transposed(rows(b), 9), 5):
        got[i, j] += n
    assert (got == a @ b.T).all()
