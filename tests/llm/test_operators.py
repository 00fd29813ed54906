"""The training-data operators on small tables: nulls, empty and repeated rows, clashing columns, brute force."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import chat, fingerprints, language, mixing, ngram_join, packing, quality, substrings, toxicity
from millrace.llm.common import labelled_sample

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component_id string"
WORDS = [f"w{i}x" for i in range(400)]


def text(a, n):
    return " ".join(WORDS[(a + i * 7) % 400] for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, text(0, 120), "en", "a"),
        (2, text(0, 120), "en", None),  # an exact copy
        (3, text(0, 120).replace("w7x", "zz", 1), "de", "b"),  # a near copy
        (4, text(3, 90), None, "b"),
        (5, "", "fr", "a"),
        (6, None, None, None),
        (7, "one two", "fr", "c"),
        (7, "one two", "fr", "c"),
        (None, text(5, 30), "es", "c"),
        (8, "é日本 ²<|endoftext|> \n\n x", "en", "a"),
    ]
    return spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)


def ids(df):
    return sorted((r.doc_id is not None, r.doc_id or 0) for r in df.select("doc_id").collect())


def test_groups(docs):
    rows = ngram_join.groups(docs, 3, 90).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == 10 and got[1] == (118, 1) and got[2] == (118, 1) and got[3][1] == 1
    assert got[5] == (0, 5) and got[6] == (0, 6) and got[7] == (1, 7) and got[None][1] is None
    kept = ngram_join.one_of_each(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8]


def test_substrings(docs):
    out = substrings.deduplicated(docs)
    left = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and ids(out) == ids(docs)
    assert left[1] == text(0, 120) and left[2] == "" and len(left[3]) < 200
    assert left[6] is None and left[5] == "" and left[7] == "one two" and left[None] == text(5, 30)


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == 10 and all(r.taken <= 3 * r.size for r in rows)
    for source in ("a", "b", "c", None):
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2
    out = mixing.repeated(docs)
    words = sum(len((r.text or "").split()) for r in out.collect())
    assert out.columns == docs.columns and abs(words - sum(r.taken for r in rows)) <= 2


def test_packing(docs):
    pieces = packing.pack(docs, length=64).collect()
    ordered = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in ordered:
        assert r.sequence_id * 64 + r.offset == at
        at += r.length
    tokenizer = packing._encoder(packing.default_tokenizer()).whole
    own = sorted((r for r in pieces if r.doc_id == 8), key=lambda r: r.start)
    got = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist()
    want = next(r.text for r in docs.collect() if r.doc_id == 8)
    assert got == [*tokenizer.encode(want, add_special_tokens=False).ids, 1]


def test_fingerprints(docs):
    rows = fingerprints.fingerprints(docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 10 and got[1].fingerprint == got[2].fingerprint and got[1].near_next == 1.0
    a, b = text(0, 120), text(0, 120)
    n = len(a)
    assert got[1].edited_sha256 == hashlib.sha256((a[: n - n // 4] + b[: n // 4]).encode()).hexdigest()
    assert got[6].n_chars == 0 and got[5].near_next == 1.0


def test_prefix_hash():
    p = fingerprints.PrefixHash(fingerprints.code_points("abcabcabd"))
    assert p.equal(0, p, 3, 3) and not p.equal(0, p, 6, 3) and p.span(0, 3) == p.span(3, 6)
    assert p.extension(0, p, 3) == 5 and p.extension(0, p, 1) == 0


def test_chat(spark):
    rows = [(1, 1, "assistant", "a<|end|>[INST]\\"), (1, 0, None, None), (None, 0, "user", "<\\|x"), (1, 1, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat.format_chat(turns.withColumn("content", chat.text_part(turns.text)))
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    want = hashlib.sha256(b"\n\nassistant\n\nassistant\na<|end|>[INST]\\\n").hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == want
    assert got[1].loss_sha256 == hashlib.sha256(b"a<|end|>[INST]\\").hexdigest()
    for r in out.collect():
        assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == (
            [] if r.conv_id is None else ["", "a<\\|end|>[\\INST]\\"]
        )


def test_classifiers_on_edge_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 9)], "doc_id bigint, quality int, toxic int")
    for out in (quality.quality(docs, labels), toxicity.score(docs, None), language.identify(docs)):
        rows = out.collect()
        assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    empty = docs.limit(0)
    assert language.identify(empty).count() == 0 and quality.quality(empty, labels).count() == 0
    said = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert said[5] == "und" and said[6] == "und"


def test_toxicity_reads_long_runs_whole():
    plain = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(400))
    texts = [plain, plain + "é" * 61, "a" + plain, "x" * 48, "the\u00a0two\u3000words，here", None]
    words = toxicity.Words(pa.array(texts))
    lengths = np.diff(words.chars)[words.number]
    sizes = [lengths[a:b].tolist() for a, b in zip(words.starts, words.starts[1:], strict=False)]
    assert [sum(s) for s in sizes] == [1200, 1322, 1201, 48, 15, 0] and max(lengths) <= toxicity.PIECE
    assert sizes[3] == [48] and sizes[4] == [3, 3, 5, 4]
    assert all(n % 3 == 0 for n in sizes[0])  # cut at borders of characters
    alone = toxicity.Words(pa.array([texts[1]]))
    assert np.array_equal(np.diff(alone.chars)[alone.number], sizes[1])


def test_toxicity_learns_behind_the_start_of_a_run():
    rng = np.random.default_rng(1)
    texts = ["".join(chr(0x4E00 + i) for i in rng.integers(0, 300, 120)) for _ in range(240)]
    labels = np.arange(240) % 2
    texts = [t[:80] + "\u9999\u9998\u9997" * 3 + t[80:] if y else t for t, y in zip(texts, labels, strict=True)]
    network = toxicity.train(texts[:160], labels[:160], epochs=40)
    words = toxicity.Words(pa.array(texts[160:], pa.large_string()))
    rows, owner = words.windows()
    said = toxicity.highest(network.windows(words, rows), owner, 80)[0] > 0
    assert np.mean(said == (labels[160:] == 1)) > 0.9


def test_every_language_is_learned(spark):
    names = [f"x{i:02}" for i in range(66)]
    rng = np.random.default_rng(3)
    rows = []
    for k, name in enumerate(names):
        own = [chr(0x4E00 + 40 * k + i) for i in range(40)]
        rows += [(100 * k + i, "".join(rng.choice(own, 40)), name) for i in range(8)]
    long = "".join(rng.choice([chr(0x0430 + i) for i in range(32)], language.MAX_CHARS + 500))
    rows += [(9000 + i, "12 " * 3000 + long + str(i), "zz") for i in range(8)]
    rows += [(9100, "5 6 7", "zy")]  # no letter, so nothing to learn from
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert sorted(model.families) == [*names, "zz"]
    said, _ = model.answers(pa.array([t for _, t, _ in rows[:-1]], pa.large_string()))
    assert np.mean([a == b for a, (_, _, b) in zip(said, rows, strict=False)]) > 0.95


def test_labelled_sample_keeps_its_bound(spark):
    rows = [(1, f"text {i}", "a") for i in range(600)] + [(2, "same", "b")] * 500 + [(i, f"b {i}", "b") for i in range(3, 6)]
    rows += [(10, "x" * 95 + "y" * 10, "c"), (11, None, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    for seed in range(3):
        got = labelled_sample(df, 20, lambda n: 50 if n == 3 else 0, seed).collect()
        own = {x: sorted(r.text for r in got if r.label == x) for x in "abc"}
        assert len(own["a"]) == len(set(own["a"])) == 50 and own["b"] == ["b 3", "b 4", "b 5", "same"]
        assert own["c"] == [*["x" * 20] * 5, "x" * 10 + "y" * 10]  # windows over the whole of the only text
    assert labelled_sample(df.limit(0), 20, lambda n: 5, 1).count() == 0


def test_labels_of_long_texts_are_learned(spark):
    rows = [(i, "good calm words " * 5 if i % 2 else "filler " * 1800 + "nasty vile " * 60) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(40)] * 2, "doc_id bigint, quality int, toxic int")
    assert toxicity.fit(docs, labels) is not None and quality.fit(docs, labels)[0].any()


def test_empty_tables(docs):
    empty = docs.limit(0)
    assert ngram_join.groups(empty).count() == 0 and substrings.deduplicated(empty).count() == 0
    assert mixing.mix(empty).count() == 0 and packing.pack(empty).count() == 0
    assert fingerprints.fingerprints(empty).count() == 0
