"""Token ids of whole texts, each distinct piece tokenised once.

A pre-tokenizer cuts a text into pieces that the model treats one by one. For
the two pre-tokenizers below and texts of settled character classes, the cuts
are found on the bytes of a whole group of texts at once; distinct pieces then
go to the model, the others are known. A vocabulary file with any other
pre-tokenizer, and texts with other characters or special tokens, go to the
tokenizer whole. The cache is bounded by bytes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_BYTES = 64 << 20       # of a Python worker
PIECE_BYTES = 200            # of a cached piece beside its letters and ids
LONG = 1 << 18               # characters of a text given to the tokenizer at once

# The two pre-tokenizers as vocabulary files write them.
# Pieces that may start with one blank:
BLANK_LED = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
# Lower-case pieces without white space, digits one by one:
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_SPLIT = {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
WORD_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
WORD_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]

# all but: ASCII without controls, Latin letters, signs and punctuation that are neither letters nor numbers
_ODD = re.compile("[^\t-\r -~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf-\u00d6\u00d8-\u00f6\u00f8-\u024f"
                  "\u2010-\u2027\u2030-\u205e]|<\\|")
_SAFE_CUT = re.compile("(?<=[a-z]) (?=[a-z])")
LETTER, DIGIT, OTHER, BLANK, SPACE, STOP = range(6)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 255)]] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[9:14] = SPACE
_CLASS[32] = BLANK
_CLASS[255] = STOP           # no byte of UTF-8
_loaded: dict[str, "PieceTokenizer"] = {}


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: its own
    where that is printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


_WRITTEN = _byte_letters()


def find_tokenizer(name: str) -> str:
    """``name`` is a path, or a name among the public vocabularies."""
    if os.path.exists(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def cuts(buf: np.ndarray, blank_led: bool) -> np.ndarray:
    """Where pieces begin in the bytes of texts that each end with 255."""
    c = _CLASS[buf]
    lead = np.flatnonzero(buf == 0xC2)  # signs
    c[lead] = c[lead + 1] = OTHER
    lead = np.flatnonzero(buf == 0xE2)  # punctuation
    c[lead] = c[lead + 1] = c[lead + 2] = OTHER
    start = np.ones(len(c), bool)
    np.not_equal(c[1:], c[:-1], out=start[1:])
    # contractions: an apostrophe that begins a piece
    if len(at := np.flatnonzero(buf[:-1] == 39)):
        before = np.where(at > 0, c[np.maximum(at, 1) - 1], STOP)
        at = at[(before != OTHER) & ((before != BLANK) | (not blank_led))]
        one, two = buf[at + 1], buf[np.minimum(at + 2, len(buf) - 1)]
        n = np.where(np.isin(one, list(b"stmd")), 1, 0)
        n[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 2
        at, n = at[n > 0], n[n > 0]
        start[at] = True
        start[at + 1] = False
        start[at + 1 + n] = True
    if blank_led:
        white = (c == BLANK) | (c == SPACE)
        start[1:][white[1:] & white[:-1]] = False
        # the last of a run of white space, unless the text ends there, is apart; a blank leads what follows
        last = np.flatnonzero(white[:-1] & ~white[1:])
        last = last[c[last + 1] != STOP]
        start[last] = True
        start[last + 1] = c[last] != BLANK
    else:
        digit = c == DIGIT
        start |= digit
    start |= c == STOP
    return np.flatnonzero(start)


class PieceTokenizer:
    """A tokenizer with the ids of pieces it has met."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        path = find_tokenizer(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, normal = spec["model"], spec["pre_tokenizer"], spec["normalizer"]
        usable = (model["type"] == "BPE" and not model["dropout"] and not spec["post_processor"]
                  and all(t["content"].startswith("<|") for t in spec["added_tokens"]))
        self.blank_led = usable and pre == BLANK_LED and not normal
        self.lower = (usable and pre == {"type": "Sequence", "pretokenizers": [WORD_SPLIT, WORD_BYTES]}
                      and normal == {"type": "Sequence", "normalizers": WORD_NORMAL})
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.code: dict[bytes, int] = {}
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.bytes = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids by the tokenizer; long texts in parts cut before a word."""
        parts, of = [], []
        for k, t in enumerate(texts):
            at = 0
            while len(t) - at > LONG and (m := _SAFE_CUT.search(t, at + LONG)):
                parts.append(t[at:m.start()])
                of.append(k)
                at = m.start()
            parts.append(t[at:] if at else t)
            of.append(k)
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for a in range(0, len(parts), 64):
            for k, e in zip(of[a:a + 64], self.tokenizer.encode_batch_fast(parts[a:a + 64], add_special_tokens=False)):
                out[k].append(np.array(e.ids, np.int32))
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in out]

    def learn(self, pieces: list[bytes]) -> None:
        """Ids of distinct pieces."""
        new = [p for p in pieces if p not in self.code]
        if not new:
            return
        size = sum(map(len, new)) + PIECE_BYTES * len(new)
        if self.bytes + size > CACHE_BYTES and self.code:
            self.clear()
            return self.learn(pieces)
        tokenize, blank, first = self.model.tokenize, _WRITTEN[32], len(self.code)
        got = []
        for p in new:
            if p == b"\xff" or self.lower and p[0] in b" \t\n\r\x0b\x0c":
                got.append([])
            else:
                # printable ASCII is written as it is
                word = blank + p[1:].decode() if p[0] == 32 and p[1:].isalnum() else "".join([_WRITTEN[b] for b in p])
                got.append([t.id for t in tokenize(word)])
        n = np.fromiter(map(len, got), np.int64, len(got))
        self.code.update(zip(new, range(first, first + len(new))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
        self.length = np.concatenate([self.length, n])
        self.ids = np.concatenate([self.ids, np.array([i for g in got for i in g], np.int32)])
        self.bytes += size + 4 * int(n.sum())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and how many each has."""
        if self.lower:
            shown = [t.lower() for t in texts]
        else:
            shown = texts
        odd = [not (self.blank_led or self.lower) or bool(_ODD.search(t)) for t in shown]
        rest = self.whole([t for t, o in zip(texts, odd) if o])
        plain = [t for t, o in zip(shown, odd) if not o]
        flat, n = self._plain(plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        if not rest:
            return flat, n
        ends = np.cumsum(n)
        inner, outer = iter([flat[e - k:e] for e, k in zip(ends.tolist(), n.tolist())]), iter(rest)
        got = [next(outer if o else inner) for o in odd]
        return np.concatenate(got), np.array([len(g) for g in got], np.int64)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = b"\xff".join([t.encode() for t in texts]) + b"\xff"
        buf = np.frombuffer(data, np.uint8)
        at = cuts(buf, self.blank_led)
        offsets = pa.py_buffer(np.append(at, len(buf)).astype(np.int64))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, offsets, pa.py_buffer(data)])
        met = pc.dictionary_encode(pieces)
        distinct = met.dictionary.to_pylist()
        self.learn(distinct)
        code = np.fromiter(map(self.code.__getitem__, distinct), np.int64, len(distinct))[met.indices.to_numpy()]
        n = self.length[code]
        total = np.cumsum(n)
        place = np.arange(int(total[-1])) + np.repeat(self.start[code] - total + n, n)
        stops = total[np.flatnonzero(buf[at] == 255)]
        return self.ids[place], np.diff(stops, prepend=0)


def tokenizer_of(name: str) -> PieceTokenizer:
    if name not in _loaded:
        _loaded[name] = PieceTokenizer(name)
    return _loaded[name]


def groups(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[list[tuple]]:
    """Rows of the batches, as tuples with their texts (columns 1 on; null: empty),
    in groups of about ``chars`` characters."""
    rows, size = [], 0
    for b in batches:
        texts = b.columns[1:]
        for k, i in enumerate(b.column(0).to_pylist()):
            row = (i, *(c[k].as_py() or "" for c in texts))
            rows.append(row)
            size += sum(map(len, row[1:]))
            if size >= chars:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows
