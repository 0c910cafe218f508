"""The operators on small tables: nulls, empty texts, ties, repeated rows, empty
tables and extra columns, against brute force or an exact round trip."""

import base64
import hashlib
import os
import tempfile
import zlib

import numpy as np
import pytest

from farelake.llm import coder
from farelake.llm import op01_suffixes as o1
from farelake.llm import op02_minhash as o2
from farelake.llm import op03_language as o3
from farelake.llm import op04_mixing as o4
from farelake.llm import op05_warc as o5
from farelake.llm import op06_shards as o6
from farelake.llm import op07_decontaminate as o7
from farelake.llm import op08_vectors as o8
from farelake.llm import op09_lines as o9
from farelake.llm import op10_tokens as o10

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, text_hash string"
WORDS = [f"w{i}" for i in range(400)]


def texts(seed=1, n=12, size=60):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(WORDS, size)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    t = texts()
    near = t[0].split()
    near[30] = "changed"
    return [*enumerate(t), (20, t[0]), (21, " ".join(near)), (22, None), (23, ""), (24, "!!!"), (25, "one"), (26, t[3] + " " + t[4] + "\n" + t[5]),
            (27, t[1]), (28, "é " * 200)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en" if i % 2 else "fr", "s", 0, "x", "y") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_repeats_against_brute_force(docs, rows, empty):
    got = {r.doc_id: r for r in o1.remove_repeats(docs).collect()}
    seen = set()
    for i, text in sorted(rows):
        t = (text or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - 99):
            if t[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(t[p:p + 100])
        rest = bytes(b for b, g in zip(t, gone) if not g)
        assert (got[i].n_bytes, got[i].n_removed, got[i].kept_sha256) == (len(t), sum(gone), hashlib.sha256(rest).hexdigest())
    assert o1.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("words", [2, 5])
def test_near_components_against_brute_force(docs, rows, empty, words):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in o2.near_components(docs, words).collect()}
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in sets}
    assert o2.near_components(empty, words).collect() == []


def test_near_components_of_whole_fine_sets_at_the_threshold(spark):
    """205 shingles and a part of 164, each shared shingle also a smaller id's:
    the two can meet in the second round only."""
    w = [f"x{i}" for i in range(206)]
    rows = [(i, f"{w[i]} {w[i + 1]}") for i in range(164)] + [(1000, " ".join(w)), (1001, " ".join(w[:165]))]
    got = {r.doc_id: r.component_id for r in o2.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == {i: min(i, 1000) for i, _ in rows}


def test_language_on_held_out_rows(spark, empty):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    j = o3.identify(d).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    held = j[j.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95 and j.score.between(0, 1).all() and len(j) == d.count()
    extra = spark.createDataFrame([(1, None, None), (2, "", None), (3, "12 !", None), (None, "the and of", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in o3.identify(extra).collect()} == {"und"}  # nothing to learn from
    assert o3.identify(empty).collect() == []


def test_language_posteriors_are_those_of_all_paths():
    rng = np.random.default_rng(0)
    e, trans = rng.normal(size=(4, 3)).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    total = np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        w = np.exp(sum(e[t, k] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        for t, k in enumerate(path):
            total[t, k] += w
    assert np.allclose(o3._forward_backward(e, np.array([4]), trans), total / total.sum(axis=1, keepdims=True), atol=1e-4)


def test_mixing_meets_the_targets(spark, empty):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    r = o4.mix(d, labels, o4.TARGETS).toPandas()
    names = [c for c in r if c.startswith("p_")]
    share = (r[names].mul(r.tokens * r.rate, axis=0)).sum()
    share /= share.sum()
    assert len(r) == d.count() and (r.rate >= 0).all()
    assert all(abs(share[c] - o4.TARGETS[c[2:]]) < 0.02 for c in names)
    none = labels.where("false")
    assert {(x.rate, x.copies) for x in o4.mix(d, none, o4.TARGETS).select("rate", "copies").distinct().collect()} == {(1.0, 1)}
    assert o4.mix(empty, none, o4.TARGETS).collect() == []


def test_warc_rejects_magic_inside_payloads(spark, tmp_dir):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "u", "a"), (2, "u", "a"), (3, "u v\n", inner), (4, None, None), (5, "u", ""), (6, "x", "WARC/1.1\r\n" * 5), (7, "x", "é\r\n\r\n" + inner + "end")]
    o5.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_dir}/w")
    got = {r.record_id: r for r in o5.read_warc(spark, f"{tmp_dir}/w").collect()}
    last = {h or "": i for i, _, h in rows}
    assert len(got) == len(rows)
    for i, _, h in rows:
        r, b = got[f"<urn:page:{i}>"], (h or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if last[h or ""] == i else ("revisit", last[h or ""]))


def test_shards_are_contiguous_and_balanced(docs, rows, empty):
    got = sorted(o6.shard_by_bytes(docs, 4).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    text = dict(rows)
    assert all(r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) and r.size == len((text[r.doc_id] or "").encode()) + 8 for r in got)
    by = {s: [r.slot for r in got if r.shard == s] for s in range(4)}
    assert all(v == list(range(len(v))) for v in by.values())
    size = [sum(r.size for r in got if r.shard == s) for s in range(4)]
    assert max(size) - min(size) <= 2 * max(r.size for r in got)
    assert o6.shard_by_bytes(empty, 4).collect() == []


def test_decontamination_finds_edited_items(spark, docs, empty):
    item = "the quick brown fox jumps over the lazy dog while seven wizards quietly judge the boxing match"
    edited = item.replace("quick", "quikc").replace("lazy", "laazy")
    d = spark.createDataFrame([(1, "Some words; " + item.upper() + " and more."), (2, "x " + edited + " y"), (3, "nothing here"), (4, None), (5, "")], "doc_id long, text string")
    b = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "tiny one")], "item_id long, text string")
    got = {r.doc_id: [(m.item_id, m.distance) for m in r.matches] for r in o7.find_items(d, b).collect()}
    assert got[1] == [(7, 0)] and got[2][0][0] == 7 and 0 < got[2][0][1] <= 4 and got[3] == got[4] == got[5] == []
    span = [r for r in o7.find_items(d, b).collect() if r.doc_id == 1][0].matches[0]
    assert ("Some words; " + item.upper())[span.span_start:span.span_end].lower() == item
    assert o7.find_items(empty, b).collect() == [] and all(not r.matches for r in o7.find_items(d, b.where("false")).collect())


def test_edit_search_against_dynamic_programming():
    rng = np.random.default_rng(4)
    for _ in range(40):
        p, t = (bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (rng.integers(1, 9), rng.integers(0, 20)))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, x in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
            row = new
        assert o7.edit_search(p, o7.char_masks(p), t)[0] == min(row)


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 16))
    rows = [(i, (base[i % 6] + rng.normal(size=16) * (0.02 if i < 60 else 2)).tolist()) for i in range(120)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, [0.0] * 16), (204, [float("nan")] * 16), (205, [None] * 16), (206, []), (207, [1.0, 2.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in o8.vector_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int".replace(", label int", ""))).collect()}
    good = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: {j for j, y in good if j != i and x @ y >= 0.95} for i, x in good}
    root = {i: i for i, _ in rows}
    for _ in range(10):
        for i, near in links.items():
            for j in near:
                root[i] = root[j] = min(root[i], root[j])
    assert got == {i: (len(links.get(i, ())), root[i], root[i] == i) for i, _ in rows}


def test_lines_keep_one_occurrence(spark, empty):
    long = " ".join(WORDS[:200])
    near = long.replace("w150", "x150")
    d = spark.createDataFrame([(1, f"Alpha  beta!\n{long}\n\n"), (2, f"alpha beta\n{near}\n--"), (3, None), (4, ""), (5, f"{long}\n{long}")], "doc_id long, text string")
    lines = o9.line_groups(d)
    kept = {(r.doc_id, r.line) for r in lines.collect() if r.kept}
    sims = {r.rid: r.sim for r in o9.simhashes(spark.createDataFrame([(0, long, 200), (1, near, 200)], "rid long, norm string, words int")).collect()}
    linked = (sims[0] ^ sims[1]).bit_count() <= o9.DISTANCE
    assert kept == {(1, 0), (1, 1), (1, 2), (1, 3), (2, 2), (4, 0)} | (set() if linked else {(2, 1)})
    out = {r.doc_id: r.text for r in o9.rebuild(lines).collect()}
    assert out[1] == f"Alpha  beta!\n{long}\n\n" and out[3] is None and out[4] == "" and out[5] == ""
    assert o9.line_groups(empty).collect() == []


def test_lines_against_all_pairs(spark):
    """Recall against the edit similarity of all pairs, lines of 6 to 50 words."""
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(2000)]
    rows = []
    for n in (6, 8, 10, 15, 20, 50):
        for r in (1, 1, 1, max(1, n // 10), max(1, n // 5)):
            for mistyped in (False, True):
                a = list(rng.choice(vocabulary, n))
                b = list(a)
                for j in rng.choice(n, r, replace=False):
                    b[j] = b[j][:1] + "q" + b[j][1:] if mistyped else str(rng.choice(vocabulary))
                rows += [" ".join(a), " ".join(b)]
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    pairs = d.selectExpr("doc_id a", "text ta").crossJoin(d.selectExpr("doc_id b", "text tb")).where(
        "a < b and levenshtein(ta, tb) <= floor(greatest(length(ta), length(tb)) * 20 / 100)").select("a", "b").collect()
    root = list(range(len(rows)))
    for _ in rows:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    want = {i for i, r in enumerate(root) if r != i}
    got = {r.doc_id for r in o9.line_groups(d).where("not kept").collect()}
    assert len(want) > 40 and got <= want and len(got) >= 0.95 * len(want)


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 20000])
def test_coder_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 49000
    s = coder.pack(ids)
    assert np.array_equal(coder.unpack(s), ids)
    if n > 4096:
        assert np.array_equal(coder.unpack_block(s, 1), ids[4096:8192])
    if n:
        with pytest.raises(ValueError):
            coder.unpack(s[:-1] + bytes([s[-1] ^ 1]))


def test_token_files_against_the_tokenizer(spark, docs, rows, empty, tmp_dir):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(o10.TOKENIZER))
    o10.write_tokens(docs, f"{tmp_dir}/t")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in o10.read_tokens(spark, f"{tmp_dir}/t").collect()}
    at = 0
    for i, text in sorted(rows):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[i] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    o10.write_tokens(empty, f"{tmp_dir}/e")
    assert o10.read_tokens(spark, f"{tmp_dir}/e").collect() == []


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in p.STAGES:
        out = step(spark, docs, sf)
        assert name == "tokens" or out.columns == docs.columns
        docs = p.stage(out, f"test-{name}")
    assert 0 < docs.count() and set(docs.columns) == {"doc_id", "start", "n_tokens", "ids_crc32"}


def test_near_components_of_an_id_with_several_texts(spark):
    t = "a b c d e f g h i"
    for other in ("zz yy xx", "a2 b2 c2 d2 e2 f2 g2 h2 i2 j2 k2"):
        df = spark.createDataFrame([(1, t), (1, other), (3, t + " q")], "doc_id long, text string")
        got = {(r.doc_id, r.component_id, r.kept) for r in o2.near_components(df, 2).collect()}
        assert got == {(1, 1, True), (3, 1, False)}


def test_variants_below_the_threshold_seldom_meet(spark, monkeypatch):
    """Variants of one text, most pairs well below the threshold, one pair above it."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for v in range(60):
        w = list(base)
        for j in rng.choice(400, 40, replace=False):
            w[j] = f"v{v}x{j}"
        rows.append((v, " ".join(w)))
    rows.append((60, rows[59][1] + " one more"))
    tables, stage = {}, o2.stage
    monkeypatch.setattr(o2, "stage", lambda df, tag, **o: tables.setdefault(tag, stage(df, tag, **o)) if tag == "op2-rest" else stage(df, tag, **o))
    got = {r.doc_id: r.component_id for r in o2.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == {i: min(i, 59) for i, _ in rows}
    assert tables["op2-rest"].count() < 60


@pytest.mark.parametrize("make", [lambda n: np.full(n, 7), lambda n: np.arange(n) % 2 * 65534, lambda n: np.random.default_rng(3).integers(0, 65535, n)])
def test_coder_on_even_and_single_ids(make):
    ids = make(9000)
    s = coder.pack(ids)
    assert np.array_equal(coder.unpack(s), ids) and np.array_equal(coder.unpack_block(s, 2), ids[8192:])


def test_coder_counts_a_segment_once():
    """Blocks share their segment's tables: little is lost against its order-0 frequencies."""
    rng = np.random.default_rng(4)
    ids = np.where(rng.random(200_000) < 0.3, 5, rng.zipf(1.3, 200_000) % 3000)
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    assert len(coder.pack(ids)) < 1.2 * -(share * np.log2(share)).sum() * len(ids) / 8


@pytest.mark.parametrize("ids, most", [
    (np.tile([1, 2, 1, 3], 4096), 400),                                                                             # order 2 alone tells what follows 1
    (np.concatenate([np.tile(np.random.default_rng(i).integers(0, 60_000, 512), 8) for i in range(8)]), 20_000),  # a block repeats itself
])
def test_coder_learns_from_the_block(ids, most):
    """The mixing of orders 0 to 2 beside the segment's tables, under which alone
    the blocks took 1,056 and 48,900 bytes."""
    tables, blocks = coder.encode(ids)
    assert np.array_equal(coder.decode(tables, blocks, len(ids)), ids)
    assert sum(map(len, blocks)) < most


def test_coder_model_is_reset_by_block():
    ids = np.tile(np.random.default_rng(6).integers(0, 900, 4096), 3)
    s = coder.pack(ids)
    assert all(np.array_equal(coder.unpack_block(s, i), ids[:4096]) for i in range(3))
    _, blocks = coder.encode(ids)
    assert len({b for b in blocks}) == 1


def test_tokens_stage_mixes_orders(spark):
    """What the pipeline's last stage writes is learned from each block, and read again whole."""
    texts = [" ".join(["alpha beta alpha gamma"] * 3000), "one two " * 5000, None]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    path = os.path.join(tempfile.mkdtemp(prefix="farelake-test-"), "tokens")
    o10.write_tokens(docs, path)
    bodies = [bytes(r.body) for r in spark.read.parquet(path).select("body").collect()]
    got = o10.stage_tokens(spark, docs, "").orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [12_001, 10_001, 1]
    assert [(r.start, r.ids_crc32) for r in got] == [(r.start, r.ids_crc32) for r in o10.read_tokens(spark, path).orderBy("doc_id").collect()]
    assert sum(map(len, bodies)) < 700
