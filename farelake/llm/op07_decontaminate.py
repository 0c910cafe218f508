"""Benchmark decontamination: edit-distance search by CGK embedding.

The CGK walk reads a string through a pointer: at step j it writes the
character under the pointer and advances by a random bit that depends on j and
that character. Two walks with the same bits fall back into step after an edit,
so strings at a small edit distance give outputs at a small Hamming distance.
Bit sampling then turns that into lookups: each of ``KEYS`` keys is a hash of
``SAMPLED`` fixed positions of the output.

Windows start at every word of a document and at every word of an item, and an
item's window runs to the item's end, so a contaminated passage has as many
chances to meet as it has words. A meeting proposes where the item would lie;
the item-sized window there is verified by exact edit distance (bit-parallel,
best substring). Nothing is shuffled: the items' keys go to the documents, in
blocks of ``BLOCK_BYTES`` of benchmark text, one pass a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import ship

STEPS = 64            # of the walk; about 32 characters
SAMPLED = 14
KEYS = 6
SHORT = 48            # items below this many bytes are only found unedited
BLOCK_BYTES = 8 << 20
WINDOWS = 1 << 14     # walked at once
GROUP_BYTES = 1 << 20  # documents handled at once
FILTER_BITS = 22

_rng = np.random.default_rng(11)
ADVANCE = _rng.integers(0, 2, (STEPS, 256)).astype(np.intp)
PICKS = np.array([np.sort(_rng.choice(STEPS, SAMPLED, replace=False)) for _ in range(KEYS)])
CODES = _rng.integers(0, 1 << 63, (KEYS, SAMPLED, 256), dtype=np.uint64) * np.uint64(2)  # of each sampled character

_CLASS = np.zeros(256, np.uint8)  # what a byte becomes: lower-case letter or digit, itself above ASCII, else a blank
_CLASS[:] = 32
_CLASS[48:58] = np.arange(48, 58)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def normalise(text: bytes) -> tuple[bytes, np.ndarray]:
    """Lower-cased words with single blanks (one in front, one behind), and each byte's place in the text."""
    buf = _CLASS[np.frombuffer(b" " + text + b" ", np.uint8)]
    blank = buf == 32
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]
    at = np.flatnonzero(keep)
    return buf[at].tobytes(), at - 1


def walk_keys(buf: np.ndarray, starts: np.ndarray, lengths: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the windows at ``starts`` (KEYS rows), and, if asked for, the
    bytes each key has read. ``buf`` has STEPS bytes of padding behind the text."""
    keys, used = np.zeros((KEYS, len(starts)), np.uint64), np.zeros((KEYS, len(starts)), np.int32)
    at = starts.astype(np.intp)
    where: list[list[tuple[int, int]]] = [[] for _ in range(STEPS)]
    for k in range(KEYS):
        for i, s in enumerate(PICKS[k]):
            where[s].append((k, i))
    for j in range(STEPS):
        c = buf.take(at).astype(np.intp)  # indices of the machine's size need no further conversion
        for k, i in where[j]:
            keys[k] += CODES[k, i].take(c)
            if lengths and i == SAMPLED - 1:
                used[k] = at - starts + 1
        at += ADVANCE[j].take(c)
    return keys + np.arange(KEYS, dtype=np.uint64)[:, None], used


def edit_search(pattern: bytes, masks: dict[int, int], text: bytes) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a substring of ``text``, and the end of the first such."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score < best:
            best, end = score, j + 1
        ph = (ph << 1) & full
        pv = ((mh << 1) & full) | (full & ~(xv | ph))
        mv = ph & xv
    return best, end


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed trigrams; a collision can only raise a common count."""
    b = np.frombuffer(text, np.uint8).astype(np.int32)
    return np.bincount((b[:-2] * 31 + b[1:-1] * 1009 + b[2:] * 7919) & 4095 if len(b) > 2 else [], minlength=4096)


def in_groups(texts: list[bytes]) -> Iterator[slice]:
    """Runs of texts of about ``GROUP_BYTES``."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= GROUP_BYTES:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def search_column(searcher: "Searcher", column: pa.Array) -> list[list[tuple[int, int, int, int]]]:
    """Matches of a batch's texts; a null has none."""
    raws = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column]
    return [sorted(m) for g in in_groups(raws) for m in searcher.matches(raws[g])]


def char_masks(pattern: bytes) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


@dataclass
class Index:
    """The items of a block with the sorted keys of their windows."""
    ids: list[int]
    items: list[bytes]
    percent: int
    keys: np.ndarray = field(init=False)
    item_of: np.ndarray = field(init=False)
    shift_of: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        keys, item_of, shift_of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for n, t in enumerate(self.items):
            if len(t) >= SHORT:
                buf = np.frombuffer(t + b" " * STEPS, np.uint8)
                starts = np.flatnonzero(buf[:len(t) - 1] == 32)
                k, used = walk_keys(buf, starts, lengths=True)
                ok = starts[None, :] + used <= len(t)  # later bytes are not the item's
                keys.append(k[ok])
                shift_of.append(np.broadcast_to(starts, k.shape)[ok].astype(np.int32))
                item_of.append(np.full(int(ok.sum()), n, np.int32))
        keys, self.item_of, self.shift_of = (np.concatenate(x) for x in (keys, item_of, shift_of))
        order = np.argsort(keys, kind="stable")
        self.keys, self.item_of, self.shift_of = keys[order], self.item_of[order], self.shift_of[order]


class Searcher:
    """An index with what a task builds from it."""

    def __init__(self, index: Index):
        self.index = index
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[index.keys >> np.uint64(64 - FILTER_BITS)] = True
        self.masks: dict[int, tuple] = {}
        self.short = None
        if any(len(t) < SHORT for t in index.items):
            self.short = ahocorasick.Automaton()
            for n, t in enumerate(index.items):
                if 2 < len(t) < SHORT:
                    key = t.decode("latin-1")
                    self.short.add_word(key, (self.short.get(key, ((), 0))[0] + (n,), len(t)))
            if len(self.short):
                self.short.make_automaton()
            else:
                self.short = None

    def proposals(self, texts: list[bytes]) -> list[dict[int, list[int]]]:
        """For each text: item -> places where it might start."""
        ix = self.index
        buf = np.frombuffer(b"".join(t + b" " * STEPS for t in texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        base = np.cumsum(sizes + STEPS) - sizes - STEPS
        blank = buf == 32
        blank[:-1] &= buf[1:] != 32  # a blank before a word
        blank[-1] = False
        starts = np.flatnonzero(blank)
        out: list[dict[int, set[int]]] = [{} for _ in texts]
        for lo in range(0, len(starts), WINDOWS):
            s = starts[lo:lo + WINDOWS]
            keys, _ = walk_keys(buf, s)
            k, w = np.nonzero(self.filter[keys >> np.uint64(64 - FILTER_BITS)])
            found = keys[k, w]
            a, b = np.searchsorted(ix.keys, found, "left"), np.searchsorted(ix.keys, found, "right")
            for x in np.flatnonzero(b > a):
                at = int(s[w[x]])
                doc = int(np.searchsorted(base, at, "right")) - 1
                for y in range(a[x], b[x]):
                    out[doc].setdefault(int(ix.item_of[y]), set()).add(at - int(base[doc]) - int(ix.shift_of[y]))
        return [{n: sorted(d) for n, d in o.items()} for o in out]

    def matches(self, raws: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """For each text: (item id, distance, start byte, end byte) of the best place of each item found."""
        normal = [normalise(r) for r in raws]
        return [self._verified(t, place, p) for (t, place), p in zip(normal, self.proposals([t for t, _ in normal]))]

    def _verified(self, text: bytes, place: np.ndarray, proposed: dict[int, list[int]]) -> list[tuple[int, int, int, int]]:
        best: dict[int, tuple[int, int, int]] = {}
        for n, diagonals in proposed.items():
            item = self.index.items[n]
            limit = len(item) * self.index.percent // 100
            done = -1 << 60
            for d in diagonals:
                if d <= done:
                    continue
                done = d + limit
                lo = max(0, d - limit)
                part = text[lo:d + limit * 2 + len(item)]
                at = part.find(item)
                if at >= 0:
                    best[n] = (0, lo + at, lo + at + len(item))
                    break
                if n not in self.masks:
                    self.masks[n] = (char_masks(item), item[::-1], char_masks(item[::-1]), trigrams(item))
                fwd, back, back_masks, grams = self.masks[n]
                # an edit destroys three trigrams at most
                if np.minimum(grams, trigrams(part)).sum() < len(item) - 2 - 3 * limit:
                    continue
                score, end = edit_search(item, fwd, part)
                if score <= limit and (n not in best or score < best[n][0]):
                    _, length = edit_search(back, back_masks, part[:end][::-1])
                    best[n] = (score, lo + end - length, lo + end)
        if self.short:
            for end, (ns, size) in self.short.iter(text.decode("latin-1")):
                for n in ns:
                    best.setdefault(n, (0, end + 1 - size, end + 1))
        # blanks at both ends are not part of the span
        return [(self.index.ids[n], d, int(place[min(a + 1, b - 1)]), int(place[max(b - 2, a)]) + 1) for n, (d, a, b) in best.items()]


def _indexes(benchmark: DataFrame, percent: int, id_col: str, text_col: str) -> Iterator[Index]:
    """The benchmark in blocks of bounded size, each collected when its pass is built."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = -(-total // BLOCK_BYTES)
    for b in range(blocks):
        rows = sorted((r.id, normalise(r.text.encode())[0]) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect())
        rows = [r for r in rows if len(r[1]) > 2]
        yield Index([i for i, _ in rows], [t for _, t in rows], percent)


def find_items(docs: DataFrame, benchmark: DataFrame, percent: int = 15, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id") -> DataFrame:
    """(id, matches) for every row: the items found in it as an array of
    (item_id, distance, span_start, span_end), spans in bytes of the text.

    An item is found where its normalised text (lower-cased letters and digits,
    single blanks) is within ``percent`` percent of its bytes in edits of some
    part of the document's. Items below ``SHORT`` bytes must occur unedited.
    Empty items and null texts match nothing; an empty benchmark gives no
    matches, an empty table no rows. Other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = "array<struct<item_id:bigint,distance:int,span_start:bigint,span_end:bigint>>"
    blocks = None
    for index in _indexes(benchmark, percent, item_col, text_col):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(index)
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("span_start", pa.int64()), ("span_end", pa.int64())]))
            for b in batches:
                got = [[dict(zip(("item_id", "distance", "span_start", "span_end"), m)) for m in ms] for ms in search_column(searcher, b.column(1))]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, kind)], ["id", "text", "m"])
        got = out.select("id", "text", *([] if blocks is None else ["matches"]))
        if blocks is None:
            out = got.mapInArrow(run, f"id {kind}, text string, m {found}").withColumnRenamed("m", "matches")
        else:
            out = _more(got, run, kind, found)
        blocks = True
    if blocks is None:
        out = out.withColumn("matches", F.expr(f"cast(array() as {found})"))
    return out.select(F.col("id").alias(id_col), "matches")


def _more(got: DataFrame, run, kind: str, found: str) -> DataFrame:
    """A further block's matches, beside those there are."""
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def first(source):
            for b in source:
                held.append(b.column(2))
                yield b
        for r in run(first(batches)):
            old = held.pop(0).to_pylist()
            new = r.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([r.column(0), r.column(1), pa.array([a + b for a, b in zip(old, new)], r.column(2).type)],
                                             ["id", "text", "matches"])
    return got.mapInArrow(both, f"id {kind}, text string, matches {found}")


def op7_cgk_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a document: whether it is contaminated, by which items, and the closest one's span."""
    found = find_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    best = F.array_min(F.transform("matches", lambda m: F.struct(m["distance"].alias("distance"), m["item_id"].alias("item_id"),
                                                                 m["span_start"].alias("span_start"), m["span_end"].alias("span_end"))))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.transform("matches", lambda m: m["item_id"]).alias("item_ids"),
                        best["item_id"].alias("best_item"), best["distance"].alias("distance"),
                        best["span_start"].alias("span_start"), best["span_end"].alias("span_end"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = 15) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    ship(spark)
    at = docs.columns.index("text")
    for index in _indexes(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent, "item_id", "text"):
        def keep(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(index)
            for b in batches:
                yield b.filter(pa.array([not m for m in search_column(searcher, b.column(at))], pa.bool_()))
        docs = docs.mapInArrow(keep, docs.schema)
    return docs
