"""Periodic runs of words inside documents, by descending-LCP Kruskal.

Suffixes of a document's word sequence are united to classes by decreasing
longest common prefix (union-find, the smaller class into the larger). A class
is an ordered set of positions. When a position joins a class at level ``lcp``,
it becomes the neighbour of at most two others; a neighbour at distance
``d <= lcp`` means that ``d + lcp`` words from the first of the two on have
period ``d``. ``d`` is their smallest period, as a smaller one would have put a
position between the two at a higher level. Every run shows up in this way from
its first word on, so what starts earlier with the same period is not a seed.

A run of ``least`` words or more, twice its period at least, needs an LCP of
half of ``least``. So classes below that level are never formed, and only
positions whose next ``least / 2`` words occur again in the document are sorted:
few in ordinary text. Words are numbered exactly (dictionary encoding) and the
classes of the lowest level are compared word by word.

A document is one row of one task, there is no shuffle. Texts are taken in
groups of about ``GROUP_BYTES``; memory is about 60 bytes a word of a group
and, beyond it, about 300 bytes for each position that repeats.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import SPACE, mix64, ship

GROUP_BYTES = 1 << 20
BLOCK = 512
SCHEMA = ("id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "n_dropped long, runs_sha256 string, collapsed_sha256 string")


class Places:
    """An ordered set of positions, in blocks, so that an insertion moves few."""

    __slots__ = ("blocks", "last")

    def __init__(self, place: int):
        self.blocks, self.last = [[place]], [place]

    def add(self, place: int) -> tuple[int, int]:
        """The neighbours of the new position, -1 where there is none."""
        k = bisect_left(self.last, place)
        if k == len(self.last):
            k, after = k - 1, -1
            block = self.blocks[k]
            before = block[-1]
            block.append(place)
            self.last[k] = place
        else:
            block = self.blocks[k]
            i = bisect_left(block, place)
            after = block[i]
            before = block[i - 1] if i else (self.last[k - 1] if k else -1)
            block.insert(i, place)
        if len(block) > 2 * BLOCK:
            self.blocks[k:k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.last[k:k + 1] = [block[BLOCK - 1], block[-1]]
        return before, after


def seeds(place: list[int], lcp: list[int], order: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(first position, distance, lcp) of neighbours at a distance within the
    LCP. ``place`` lists the suffixes in their order, ``lcp[e]`` is that of
    ``e`` and ``e + 1``, ``order`` the edges from the largest on."""
    parent, size = list(range(len(place))), [1] * len(place)
    sets: list[Places | None] = [None] * len(place)
    at, gap, level = [], [], []
    for e in order:
        a, b = e, e + 1
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if size[a] < size[b]:
            a, b = b, a
        into, now = sets[a], lcp[e]
        if into is None:
            into = sets[a] = Places(place[a])
        joins, own = [place[b]] if sets[b] is None else [x for block in sets[b].blocks for x in block], -1
        for k, x in enumerate(joins):
            before, after = into.add(x)
            # neighbours that come from the same class are not new
            if before > own and x - before <= now:
                at.append(before)
                gap.append(x - before)
                level.append(now)
            own = x
            if after >= 0 and after - x <= now and not (k + 1 < len(joins) and joins[k + 1] < after):
                at.append(x)
                gap.append(after - x)
                level.append(now)
        sets[b], parent[b] = None, a
        size[a] += size[b]
    return at, gap, level


def _repeated(word: np.ndarray, doc: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``gram`` words occur at another position of the
    document too, and their classes (equal words, equal document)."""
    none = np.zeros(0, np.int64)
    n = len(word) - gram + 1
    if n < 2:
        return none, none
    key = doc[:n].astype(np.uint64)
    for i in range(gram):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + word[i:n + i].astype(np.uint64))
    whole = doc[:n] == doc[gram - 1:]
    at, key = np.flatnonzero(whole), key[whole]
    s = np.sort(key)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return none, none
    c = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hit = twice[c] == key
    at, c = at[hit], c[hit].astype(np.int64)
    by = np.argsort(c, kind="stable")
    same = c[by][1:] == c[by][:-1]
    equal = doc[at[by]][1:] == doc[at[by]][:-1]
    for i in range(gram):
        w = word[at[by] + i]
        equal &= w[1:] == w[:-1]
    if (same & ~equal).any():  # two grams of one hash
        _, c = np.unique(np.column_stack([doc[at], *(word[at + i] for i in range(gram))]), axis=0, return_inverse=True)
        c = c.reshape(-1).astype(np.int64)
    return at, c


def _suffixes(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a sequence, and the LCP of neighbours in it (prefix doubling)."""
    n, h, rank = len(first), 1, first
    levels = [rank]
    while int(rank.max()) + 1 < n:
        key = rank * (n + 1)
        key[:n - h] += rank[h:] + 1
        by = np.argsort(key, kind="stable")
        up = np.concatenate([[0], np.cumsum(key[by][1:] != key[by][:-1])])
        rank = np.empty(n, np.int64)
        rank[by] = up
        levels.append(rank.astype(np.int32) if n < 1 << 31 else rank)
        h *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b, l = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 2, -1, -1):
        l += (levels[k][np.minimum(a + l, n - 1)] == levels[k][np.minimum(b + l, n - 1)]) * (1 << k)
    return order, l


def find_runs(word: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, length, period), by start, of the runs in ``word``; ``doc``
    is the document of each word, runs stay inside one."""
    gram = max(1, -(-least // 2))
    at, c = _repeated(word, doc, gram)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # each stretch of such positions ends with a value of its own, which no other suffix shares
    cut = np.diff(at, prepend=at[:1] - 2) > 1
    where = np.arange(len(at)) + np.cumsum(cut) - 1
    n = len(at) + int(cut.sum())
    first, place = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    _, first[where] = np.unique(c, return_inverse=True)
    place[where] = at
    stops = np.flatnonzero(first < 0)
    first[stops] = int(first.max()) + 1 + np.arange(len(stops))
    order, l = _suffixes(first)
    edges = np.flatnonzero(l)
    edges = edges[np.argsort(-l[edges], kind="stable")]
    start, period, lcp = (np.array(x, np.int64) for x in seeds(place[order].tolist(), (l + gram - 1).tolist(), edges.tolist()))
    ok = period + lcp >= least
    start, period, lcp = start[ok], period[ok], lcp[ok]
    # a run's first word: the one before doesn't keep the period
    left = np.maximum(start - 1, 0)
    ok = (start == 0) | (doc[left] != doc[start]) | (word[left] != word[left + period])
    start, period, lcp = start[ok], period[ok], lcp[ok]
    by = np.lexsort([period, start])
    return np.column_stack([start, period + lcp, period])[by]


def _group(ids: list[int | None], texts: list[bytes], least: int, rewrite) -> pa.RecordBatch:
    joined = b" ".join(texts) + b" "
    buf = np.frombuffer(joined, np.uint8)
    is_word = ~SPACE[buf]
    edge = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
    begin, length = edge[::2], edge[1::2] - edge[::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    bound = np.concatenate([[0], np.searchsorted(begin, ends)])
    letters = buf[is_word]
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    word = pc.dictionary_encode(words).indices.to_numpy()
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bound))
    # all words, each with one blank behind it
    after = is_word.copy()
    after[1:] |= is_word[:-1]
    spaced = np.where(is_word, buf, 32).astype(np.uint8)[after]
    at = offsets[:-1] + np.arange(len(begin))
    source, moved = np.arange(len(begin)), set()
    for d, i in enumerate(ids):
        n = int(bound[d + 1] - bound[d])
        plan = rewrite(i, n) if rewrite and i is not None and n else None
        if plan:
            a, p = plan
            source[bound[d] + a:bound[d + 1]] = bound[d] + a + np.arange(n - a) % p
            moved.add(d)
    if moved:
        word = word[source]
    runs = find_runs(word, doc, least)
    cover = np.zeros(len(begin) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(cover[:-1]) == 0
    of = np.searchsorted(runs[:, 0], bound)
    out = []
    for d, i in enumerate(ids):
        lo, hi = int(bound[d]), int(bound[d + 1])
        mine = runs[of[d]:of[d + 1]] - [lo, 0, 0]
        best = max(mine.tolist(), key=lambda r: (r[1], -r[0], -r[2]), default=None)
        start, size, period = best or (None, None, None)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in mine.tolist())
        if best is None and d not in moved:
            rest = spaced[at[lo]:at[hi - 1] + length[hi - 1]] if hi > lo else spaced[:0]
        else:
            s = source[lo:hi][keep[lo:hi]]
            n = length[s] + 1
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            rest = spaced[np.repeat(at[s], n) + step][:-1]
        out.append((i, hi - lo, len(mine), start, size, period, 1000 * size // period if best else None, int((~keep[lo:hi]).sum()),
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(np.ascontiguousarray(rest)).hexdigest()))
    kinds = [pa.int64()] * 8 + [pa.string()] * 2
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def word_runs(docs: DataFrame, least: int = 12, rewrite: Callable[[int, int], tuple[int, int] | None] | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: id, n_words, n_runs, start, length, period and
    exponent_milli of the longest run (ties: smallest start, then period; four
    nulls without a run), n_dropped, runs_sha256, collapsed_sha256.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, numbered from 0. A run is
    a stretch of words with smallest period q, of at least ``least`` and 2 q
    words, that can't be extended. A word is dropped if a run contains it after
    that run's first q words. ``rewrite(id, n_words)`` may return (a, p): from
    word ``a`` on, the document then repeats the ``p`` words there.

    Null and empty texts have no words and no runs, both digests are that of
    nothing. Rows that repeat an id each get their own row; a null id stays null
    and is never rewritten. An empty table gives an empty one; other columns
    are ignored.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids.append(i)
                texts.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
                size += len(texts[-1]) + 1
                if size >= GROUP_BYTES:
                    yield _group(ids, texts, least, rewrite)
                    ids, texts, size = [], [], 0
            if ids:
                yield _group(ids, texts, least, rewrite)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)


def planted(doc_id: int, n: int) -> tuple[int, int] | None:
    """A tenth of the documents, by the CRC of the id, end with a repetition."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % n
    return (a, 1 + (n - a) // (3 + g % 8)) if h % 10 == 0 else None


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), rewrite=planted).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_dropped")
