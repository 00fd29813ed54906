"""Byte-level BPE and tokenizer alignment against plain versions that see one text after another."""

import base64
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from millrace.llm import alignment, blocks, byte_bpe
from millrace.llm.packing import _byte_values
from millrace.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, ids string, block string, n_tokens string, groups string, pairs string"
EDGES = [
    "", None, " ", "   ", "\n", " a", "a ", "  two  spaces ", "don't we'll 'S", "x▁y", "<s> </s> <|endoftext|> <0x0A> <unk>",
    "日本語のテキスト 中文，标点。", "é ﬁ ª²", "😀👍🏽 👨‍👩", " nb　wide thin", "a\x00b\x1cc\r\n\t\td",
    "12345 ١٢٣ 3.14159", "the " * 3000, "q" * 5000, "same", "same",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i % 18 if i else None, t, "x", "y", None, "z", "") for i, t in enumerate(EDGES)]
    return spark.createDataFrame(rows, DOCS)


def table(name="documents"):
    return pq.read_table(f"{SMALL}/{name}.parquet").to_pylist()


def counted(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# -- encoding ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import tiktoken

    lines = map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("whole", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plainly_encoded(rows, library):
    out = Counter()
    for doc_id, text in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        digests = (hashlib.sha256(x).hexdigest() for x in (ids, (text or "").encode()))
        out[(doc_id, len(ids) // 4, *digests)] += 1
    return out


BPE = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def test_bpe_query_equals_the_library(spark, library):
    want = plainly_encoded([(r["doc_id"], r["text"]) for r in table()], library)
    assert counted(QUERIES["op13_byte_bpe"](spark, SMALL), BPE) == want


@pytest.mark.parametrize("size", [1, 200, 1 << 20])
def test_bpe_on_edge_texts_in_blocks_of_any_size(docs, library, monkeypatch, size):
    # A mock of the constant does not reach the workers, so the generator itself is cut here.
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    monkeypatch.setattr(blocks.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda s: 3})()))
    cut = list(blocks.document_blocks(iter([batch, batch.slice(0, 0), batch.slice(2, 3)]), size))
    every = [(i, t) for _, ids, texts in cut for i, t in zip(ids.to_pylist(), texts, strict=True)]
    assert every == [(i, t or "") for i, t in rows + rows[2:5]]
    assert len({key for key, _, _ in cut}) == len(cut)
    assert counted(byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs))), BPE) == plainly_encoded(rows, library)


def test_bpe_splits_and_merges_every_character_like_the_library(library):
    split, merge = byte_bpe._splitter(P.PATTERN), byte_bpe._merger(byte_bpe.default_ranks())
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 2048):
        text = "".join(f"{c} {c}a1 " for c in chars[at : at + 2048])
        assert [i for w in split(text) for i in merge(w)] == library.encode_ordinary(text)


def test_bpe_of_an_empty_table_and_of_a_long_text(spark, docs, library):
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0))).collect() == []
    text = ("word%d " * 400_000) % tuple(range(400_000)) + "ß" * 100_000
    long = spark.createDataFrame([(1, text), (2, "after"), (1, text)], "doc_id bigint, text string")
    want = plainly_encoded([(1, text), (2, "after"), (1, text)], library)
    assert counted(byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(long))), BPE) == want


def test_decoding_refuses_unknown_ids_and_takes_nothing_as_empty(spark):
    ids = np.array([50_000, 1], "<u4").tobytes()
    rows = spark.createDataFrame([(1, bytearray(ids)), (2, bytearray()), (3, None)], "doc_id bigint, ids binary")
    decoded = {r.doc_id: r.decoded for r in byte_bpe.decode(rows).collect()}
    assert decoded[2] == decoded[3] == b"" and len(decoded[1]) > 1
    wrong = spark.createDataFrame([(1, bytearray(np.array([99_999], "<u4").tobytes()))], "doc_id bigint, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(wrong).collect()


def test_squeezed_numbers_come_back():
    for numbers in ([], [0], [2**32 - 1], list(range(5000)), [7] * 9):
        given = np.array(numbers, np.uint32)
        assert blocks.unsqueezed(blocks.squeezed(given), len(given)).tolist() == numbers


# -- alignment ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def plainly_aligned(rows, tokenizers):
    """Every pair of tokens by its byte ranges; counts over all rows."""
    first, model = tokenizers
    byte = _byte_values()
    found = []
    for doc_id, text in rows:
        sides = [[], []]
        if text:
            a = first.encode(" " + text, add_special_tokens=False)
            sides[0] = [(i, bytes(byte[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
            for i in model.encode(text):
                piece = model.id_to_piece(i)
                sides[1].append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
            if any(b"".join(t for _, t in side) != (" " + text).encode() for side in sides):
                sides = [[], []]
        ends = [list(np.cumsum([len(t) for _, t in side], dtype=int)) for side in sides]
        cut = sorted(set(ends[0]) & set(ends[1]))
        links, groups, done = [], [], [0, 0]
        for end in cut:
            at = [ends[s].index(end, done[s]) for s in (0, 1)]
            links.append((sides[0][at[0]][0], sides[1][at[1]][0]))
            groups.append("|".join(",".join(str(i) for i, _ in sides[s][done[s] : at[s] + 1]) for s in (0, 1)))
            done = [at[0] + 1, at[1] + 1]
        found.append((doc_id, len(sides[0]), len(sides[1]), links, ";".join(groups)))
    count = Counter(link for f in found for link in f[3])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return Counter(
        (
            doc_id, n_a, n_b, len(links), len(links), sum(count[link] == most[link[1]] for link in links),
            sum(count[link] for link in links), hashlib.sha256(said.encode()).hexdigest() if said else "",
        )
        for doc_id, n_a, n_b, links, said in found
    )


ALIGN = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_query_equals_the_plain_version(spark, tokenizers):
    want = plainly_aligned([(r["doc_id"], r["text"]) for r in table()], tokenizers)
    assert counted(QUERIES["op11_alignment"](spark, SMALL), ALIGN) == want


def test_alignment_of_edge_texts(docs, tokenizers):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = alignment.align(docs)
    assert counted(out, ALIGN) == plainly_aligned(rows, tokenizers)
    said = {r.doc_id: r for r in out.collect()}
    assert said[9].n_a == 0 and said[9].groups == "" and said[1].n_b == 0
    assert hashlib.sha256(said[8].groups.encode()).hexdigest() == said[8].groups_sha256
    assert alignment.align(docs.limit(0)).collect() == []


def test_alignment_in_many_calls_is_the_same(tokenizers, monkeypatch):
    texts = [t or "" for t in EDGES] + [r["text"] for r in table()[:40]]
    whole = alignment._aligner(*alignment.default_sides()).align(texts)
    monkeypatch.setattr(alignment, "CALL", 50)
    parts = alignment._aligner(*alignment.default_sides()).align(texts)
    assert whole[1] == parts[1] and (whole[2] == parts[2]).all()
    assert all((whole[0][c] == parts[0][c]).all() for c in alignment.COUNTS)


def test_overlaps_are_all_pairs_that_share_a_byte():
    import pandas as pd

    rng = np.random.default_rng(5)
    for _ in range(50):
        length = int(rng.integers(1, 40))
        starts = [np.concatenate([[0], np.flatnonzero(rng.random(length - 1) < 0.4) + 1]) for _ in range(2)]
        frames = [pd.DataFrame({"start": s, "doc": 0}) for s in starts]
        got = set(zip(*(x.tolist() for x in alignment.overlaps(*frames)), strict=True))
        ends = [[*s[1:], length] for s in starts]
        want = {
            (i, j)
            for i in range(len(starts[0]))
            for j in range(len(starts[1]))
            if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]
        }
        assert got == want
