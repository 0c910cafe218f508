"""Vector bin packing of tokenised examples into training sequences.

An example is a vector: tokens, segments (one a piece) and loss-bearing tokens.
A sequence has a limit on each. It is filled by the dot-product heuristic: among
the pieces that still fit, the one whose vector (as shares of the limits) has
the largest product with what is left of the sequence comes next, each
dimension weighted by what the waiting pieces demand of it. Pieces of equal
vectors form a class, so a step looks at classes, not at pieces.

Examples longer than a limit are cut into consecutive pieces. With ``cut``,
what is left of a sequence when nothing fits is filled by a part of the best
piece, unless it is shorter than ``least_part`` tokens; and the last sequences,
for which nothing is left to fill them, are dealt out to lengths that are
powers of two, which need no padding.

Each task packs pools of about ``POOL_IDS`` ids of its own rows, so there is no
shuffle and the memory is that of a pool and the longest text. A sequence never
spans two tasks: at 16 MB of text a task, the tail is below a thousandth. A
sequence's number is made of its task's and its place there; both follow from
the input splits, so a task that runs again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import ship
from farelake.llm.pieces import groups, tokenizer_of

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MAX_TOKENS, MAX_SEGMENTS = 1024, 128
LEAST_PART = 16
POOL_IDS = 1 << 20
GROUP_CHARS = 1 << 20
SCHEMA = ("id long, start long, length long, loss_tokens long, example_tokens long, sequence_id long, offset long, "
          "segment int, ids binary")


class Pieces:
    """Waiting pieces (example, start, end), by their vector (tokens, loss)."""

    def __init__(self, prompt: list[int]):
        self.prompt = prompt
        self.index: dict[tuple[int, int], int] = {}
        self.waiting: list[list[tuple[int, int, int]]] = []
        self.vector = np.zeros((64, 2), np.int64)
        self.count = np.zeros(64, np.int64)

    def loss(self, example: int, start: int, end: int) -> int:
        return max(0, end - max(start, self.prompt[example]))

    def add(self, example: int, start: int, end: int) -> None:
        key = (end - start, self.loss(example, start, end))
        k = self.index.get(key)
        if k is None:
            k = self.index[key] = len(self.waiting)
            self.waiting.append([])
            if k == len(self.count):
                self.vector = np.concatenate([self.vector, np.zeros_like(self.vector)])
                self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.vector[k] = key
        self.waiting[k].append((example, start, end))
        self.count[k] += 1

    def take(self, k: int) -> tuple[int, int, int]:
        self.count[k] -= 1
        return self.waiting[k].pop()


def pack(sizes: list[int], prompt: list[int], tokens: int, segments: int, loss: int, cut: bool,
         least_part: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (example, start, end) of examples of ``sizes``
    tokens, of which the first ``prompt`` bear no loss."""
    pieces, done = Pieces(prompt), []
    for e, n in enumerate(sizes):
        s = 0
        while s < n:
            k = min(n - s, tokens, max(0, prompt[e] - s) + loss)
            if k == tokens:
                done.append([(e, s, s + k)])
            else:
                pieces.add(e, s, s + k)
            s += k
    while (classes := len(pieces.waiting)) and (n := pieces.count[:classes]).any():
        demand = n @ pieces.vector[:classes] / (tokens, loss)
        room, left, items = np.array([tokens, loss]), segments, []
        while left:
            classes = len(pieces.waiting)
            v, here = pieces.vector[:classes], pieces.count[:classes] > 0
            # segments count alike for every piece, so they don't tell pieces apart
            value = v @ (demand * room / (tokens ** 2, loss ** 2))
            fits = here & (v <= room).all(axis=1)
            if fits.any():
                item = pieces.take(int(np.argmax(np.where(fits, value, -1.0))))
            elif cut and here.any() and room[0] >= least_part:
                item = pieces.take(int(np.argmax(np.where(here, value, -1.0))))
                e, s, end = item
                k = min(end - s, int(room[0]), max(0, prompt[e] - s) + int(room[1]))
                if k < least_part:
                    pieces.add(*item)
                    break
                pieces.add(e, s + k, end)
                item = (e, s, s + k)
            else:
                break
            items.append(item)
            left -= 1
            room = room - (item[2] - item[1], pieces.loss(*item))
        used = tokens - int(room[0])
        last = not pieces.count[:len(pieces.waiting)].any()
        if cut and last and used & (used - 1):
            done.extend(_halves(items, used))
        else:
            done.append(items)
    return done


def _halves(items: list[tuple[int, int, int]], used: int) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of a sequence, dealt out to sequences that are powers of two long."""
    items = items[::-1]
    while used:
        room, part = 1 << (used.bit_length() - 1), []
        used -= room
        while room:
            e, s, end = items.pop()
            k = min(room, end - s)
            part.append((e, s, s + k))
            room -= k
            if s + k < end:
                items.append((e, s + k, end))
        yield part


def pack_examples(examples: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, max_tokens: int = MAX_TOKENS,
                  max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, cut: bool = True,
                  least_part: int = LEAST_PART, id_col: str = "doc_id", text_col: str = "text",
                  prompt_col: str | None = None) -> DataFrame:
    """One row a piece: id, start (ids of its example before it), length,
    loss_tokens, example_tokens, sequence_id, offset in the sequence (gapless),
    segment (number in the sequence), ids (little-endian unsigned 32 bit).

    An example is the ids of ``prompt_col`` (which bear no loss; none by
    default), those of ``text_col`` and ``end_id``; null texts are empty. No
    sequence has more than ``max_tokens`` ids, ``max_segments`` pieces or
    ``max_loss`` (default: no own limit) loss-bearing ids. Without ``cut``, only
    examples beyond a limit are cut. Rows that repeat an id are examples of
    their own, a null id stays null. An empty table gives an empty one; other
    columns are ignored.
    """
    if max_tokens < 1 or max_segments < 1 or (max_loss is not None and max_loss < 1):
        raise ValueError("limits must be positive")
    ship(examples.sparkSession)
    loss = min(max_loss or max_tokens, max_tokens)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = tokenizer_of(tokenizer), TaskContext.get().partitionId() << 40
        who, prompt, ids, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal who, prompt, ids, size, number
            out = []
            for items in pack([len(x) for x in ids], prompt, max_tokens, max_segments, loss, cut, least_part):
                offset = 0
                for segment, (e, s, end) in enumerate(items):
                    out.append((who[e], s, end - s, max(0, end - max(s, prompt[e])), len(ids[e]), number, offset, segment,
                                ids[e][s:end].tobytes()))
                    offset += end - s
                number += 1
            who, prompt, ids, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for rows in groups(batches, GROUP_CHARS):
            per = len(rows[0]) - 1
            flat, n = words.encode([t for r in rows for t in r[1:]])
            stop = np.cumsum(n).reshape(-1, per)
            for k, r in enumerate(rows):
                a = int(stop[k, 0] - n[k * per])
                ids.append(np.append(flat[a:stop[k, -1]], end_id).astype("<u4"))
                prompt.append(int(n[k * per]) if per == 2 else 0)
                who.append(r[0])
                size += len(ids[-1])
                if size >= POOL_IDS:
                    yield flush()
        if ids:
            yield flush()
    texts = [F.col(c).cast("string").alias(f"t{k}") for k, c in enumerate([*([prompt_col] if prompt_col else []), text_col])]
    return examples.select(F.col(id_col).cast("long").alias("id"), *texts).mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_examples(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("example_tokens").alias("doc_tokens"),
        "sequence_id", "offset", "segment", "loss_tokens")
