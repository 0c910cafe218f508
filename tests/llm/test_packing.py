"""Pieces against the tokenizer on whole texts; packed sequences against the
examples they hold and a brute-force bound."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from farelake.llm import op13_packing as o13
from farelake.llm.pieces import PieceTokenizer

SCHEMA = "doc_id long, text string, prompt string, ids int, start string"


def encoder(name="byte_bpe_50k.json"):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_tokenizers_ids(name, monkeypatch):
    rng = np.random.default_rng(4)
    parts = ["a", "the", "Zürich", "x1", "'s", "don't", "...", "日本語", "<|endoftext|>", "<|", "\x1c", " ", "　", "é", "42", "-"]
    gaps = [" ", " ", " ", " ", "  ", "   ", "\n", "\n\n", " \n", "\n ", "\t", "", "\r\n", " \n "]
    texts = ["", " ", "\n", "a ", " a", "  a", "a  ", "a \n", "a\n b", "a\n\n  b"]
    texts += ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(int(rng.integers(1, 30)))) for _ in range(1500)]
    texts += [" ".join(rng.choice(parts[:6], 40)) for _ in range(200)]
    pieces, encode = PieceTokenizer(name), encoder(name)
    monkeypatch.setattr("farelake.llm.pieces.CACHE_BYTES", 5000)
    monkeypatch.setattr("farelake.llm.pieces.LONG", 60)
    assert (pieces.blank_led, pieces.lower) == (name[0] == "b", name[0] == "w")
    for a in range(0, len(texts), 37):
        flat, n = pieces.encode(texts[a:a + 37])
        want = [encode(t) for t in texts[a:a + 37]]
        assert n.tolist() == [len(w) for w in want]
        assert flat.tolist() == [i for w in want for i in w]


def sequences(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset, r.segment)):
        out[r.sequence_id].append(r)
    return out


def check(rows, want, tokens, segments, loss):
    """Every id in one piece, gapless offsets, no limit passed; padding as a share."""
    spent = paid = 0
    for seq in sequences(rows).values():
        assert [r.offset for r in seq] == np.cumsum([0, *(r.length for r in seq)])[:-1].tolist()
        assert [r.segment for r in seq] == list(range(len(seq)))
        used = sum(r.length for r in seq)
        assert used <= tokens and len(seq) <= segments and sum(r.loss_tokens for r in seq) <= loss
        spent += used
        paid += used if used & (used - 1) == 0 else tokens
    whole = defaultdict(list)
    for r in rows:
        whole[r.doc_id].append(r)
    got = {i: b"".join(r.ids for r in sorted(p, key=lambda r: r.start)) for i, p in whole.items()}
    assert got == {i: np.array(w, "<u4").tobytes() for i, w in want.items()}
    for i, p in whole.items():
        assert [r.start for r in sorted(p, key=lambda r: r.start)] == np.cumsum([0, *(r.length for r in sorted(p, key=lambda r: r.start))])[:-1].tolist()
        assert {r.example_tokens for r in p} == {len(want[i])} and all(len(r.ids) == 4 * r.length for r in p)
    return (paid - spent) / max(paid, 1)


@pytest.fixture(scope="module")
def examples():
    rng = np.random.default_rng(8)
    words = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 200)))), " ".join(rng.choice(words, int(rng.integers(0, 90)))), 1, "x") for i in range(250)]
    return rows + [(1000, None, None, 1, "x"), (1001, "", "p", 1, "x"), (1002, " ".join(rng.choice(words, 5000)), "q " * 700, 1, "x")]


def test_documents_are_packed_whole(spark, examples, monkeypatch):
    monkeypatch.setattr(o13, "POOL_IDS", 30_000)
    encode = encoder()
    df = spark.createDataFrame(examples, SCHEMA).repartition(2)
    want = {i: [*encode(t), 0] for i, t, *_ in examples}
    assert check(o13.pack_examples(df).collect(), want, 1024, 128, 1024) < 0.005
    assert o13.pack_examples(spark.createDataFrame([], SCHEMA)).collect() == []


def test_limits_of_instruction_data_hold(spark, examples):
    encode = encoder()
    df = spark.createDataFrame(examples, SCHEMA).coalesce(1)
    want = {i: [*encode(p), *encode(t), 7] for i, t, p, *_ in examples}
    first = {i: len(encode(p)) for i, _, p, *_ in examples}
    for cut in (True, False):
        rows = o13.pack_examples(df, end_id=7, max_tokens=900, max_segments=3, max_loss=500, cut=cut, prompt_col="prompt").collect()
        check(rows, want, 900, 3, 500)
        for r in rows:
            assert r.loss_tokens == max(0, r.start + r.length - max(r.start, first[r.doc_id]))
        if not cut:
            for i, w in want.items():
                if len(w) <= 900 and len(w) - first[i] <= 500:
                    assert len([r for r in rows if r.doc_id == i]) == 1
            # no more sequences than first-fit by falling size would open, by a tenth
            bins = []
            for w in sorted(((r.length, r.loss_tokens) for r in rows), reverse=True):
                b = next((b for b in bins if b[0] + w[0] <= 900 and b[1] + w[1] <= 500 and b[2] < 3), None)
                if b is None:
                    bins.append(b := [0, 0, 0])
                b[0], b[1], b[2] = b[0] + w[0], b[1] + w[1], b[2] + 1
            assert len({r.sequence_id for r in rows}) <= 1.1 * len(bins) + 1
    with pytest.raises(ValueError):
        o13.pack_examples(df, max_segments=0)


def test_repeated_and_null_ids(spark):
    rows = [(5, "a b", None, 1, "x"), (5, "a b", None, 1, "x"), (None, "c", None, 1, "x"), (None, None, None, 1, "x")]
    got = o13.pack_examples(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    whole = [r for r in got if r.doc_id == 5]
    assert sum(r.length for r in whole) == 6 and {r.example_tokens for r in whole} == {3}
    assert sum(r.length for r in got if r.doc_id is None) == 3


def test_query(spark):
    d = "/root/testdata/sf0.001"
    encode = encoder()
    rows = o13.op13_vector_packing(spark, d).collect()
    want = {i: [*encode(t), 0] for i, t in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    seen = defaultdict(int)
    for r in rows:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert len(ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id])
        seen[r.doc_id] += r.length
    assert seen == {i: len(w) for i, w in want.items()}
    paid = sum(u if u & (u - 1) == 0 else 1024 for u in (sum(r.length for r in s) for s in sequences(rows).values()))
    assert 1 - sum(seen.values()) / paid < 0.005
