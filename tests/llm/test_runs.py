"""Runs of words against a brute-force version that tries every period."""

import hashlib
import re
import zlib

import numpy as np

from farelake.llm import op11_runs as o11

SCHEMA = "doc_id long, text string, start string, length int, id string"


def smallest_period(w):
    back = [0] * len(w)
    for i in range(1, len(w)):
        k = back[i - 1]
        while k and w[i] != w[k]:
            k = back[k - 1]
        back[i] = k + (w[i] == w[k])
    return len(w) - back[-1]


def brute_runs(w, least=12):
    out = []
    for q in range(1, len(w) // 2 + 1):
        s = 0
        while s + q < len(w):
            e = s
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            if e + q - s >= max(least, 2 * q) and smallest_period(w[s:e + q]) == q:
                out.append((s, e + q - s, q))
            s = max(e, s) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=True):
    w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    n = len(w)
    if plant and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (n, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, len(gone),
            hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in o11.word_runs(df, **kw).collect()), key=repr)
    plant = kw.get("rewrite") is not None
    assert got == sorted(((i, *brute(i, t, plant)) for i, t in rows), key=repr)


def test_runs_of_random_words(spark, monkeypatch):
    monkeypatch.setattr(o11, "GROUP_BYTES", 3000)
    monkeypatch.setattr(o11, "BLOCK", 4)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        k, n = [(1, 40), (2, 80), (3, 150), (30, 200)][i % 4]
        w = [f"é{x}" for x in rng.integers(0, k, int(rng.integers(0, n)))]
        if i % 3 == 0 and w:  # nested repetitions
            a = int(rng.integers(0, len(w)))
            w = w[:a] + (w[a:a + 5] * 4 + ["z"]) * 3 + w[a:]
        rows.append((i, " \t".join(w) + "\n"))
    check(spark, rows)
    check(spark, rows, rewrite=o11.planted)


def test_runs_of_unusual_rows(spark):
    w = " ".join(f"w{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (4, "a " * 11), (5, "a " * 12), (6, "a\x0bb\x0c" * 6), (6, w + " " + w), (6, w + " " + w),
            (None, "x " * 30), (None, None), (90, w), (11, ("p q r s t u v " * 3 + "! ") * 4), (12, "a a " * 12), (-5, "b c " * 9)]
    check(spark, rows)
    check(spark, rows, rewrite=o11.planted)
    assert o11.word_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_of_long_texts():
    """A million equal words, and a Fibonacci word, whose number of runs is known by brute force on a part."""
    one = np.zeros(300_000, np.int32)
    assert o11.find_runs(one, one, 12).tolist() == [[0, 300_000, 1]]
    a, b = "x", "xy"
    while len(b) < 1500:
        a, b = b, b + a
    w = np.frombuffer(b.encode(), np.uint8).astype(np.int32)
    assert [tuple(r) for r in o11.find_runs(w, np.zeros(len(w), np.int32), 12).tolist()] == brute_runs(list(b))


def test_hash_collisions_are_told_apart(monkeypatch):
    monkeypatch.setattr(o11, "mix64", lambda x: x & np.uint64(3))
    rng = np.random.default_rng(5)
    w = rng.integers(0, 2, 400).astype(np.int32)
    doc = np.repeat(np.arange(4, dtype=np.int32), 100)
    want = [(100 * d + s, l, q) for d in range(4) for s, l, q in brute_runs(w[100 * d:100 * d + 100].tolist())]
    assert [tuple(r) for r in o11.find_runs(w, doc, 12).tolist()] == want


def test_query(spark):
    rows = {r.doc_id: r for r in o11.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for i, t in docs:
        if len((t or "").split()) < 800:
            r = rows[i]
            assert (r.n_words, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.n_dropped, r.runs_sha256, r.collapsed_sha256) == brute(i, t)
