"""Language identification with a linear-chain conditional random field.

A text is a sequence of words (runs of letters, lower-cased). Each word is
scored for each language by hashed features: its character 1- to 3-grams, its
prefixes and suffixes of up to three letters, and the word itself where a
lexicon learned from the sample has it. Transition weights between the
languages of neighbouring words are learned with them, from sequences that join
runs of several languages, so that code-switched text gets a label a word.
Forward-backward gives each word's posterior; a text's language is that of the
largest mean posterior, which is its score.

Training runs on the driver over a bounded sample (parameters of ``train``);
prediction is one pass over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import ship

HASH_BITS = 18
SEGMENT = 256        # words of a chain; longer texts are several chains
PIECE = 1 << 20      # characters handled at once
UNDETERMINED = "und"
_letters: np.ndarray | None = None


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray      # (2 ** HASH_BITS + lexicon, languages)
    transitions: np.ndarray  # (languages, languages)
    lexicon: np.ndarray      # sorted word hashes


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def _words(lows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased texts: letters of all words, word lengths, text of each word."""
    sizes = np.array([len(x) + 1 for x in lows])
    buf = np.frombuffer("\0".join([*lows, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[buf]
    edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    starts, lens = edge[::2], edge[1::2] - edge[::2]
    return buf[letter], lens, np.searchsorted(np.cumsum(sizes), starts, side="right")


def _features(letters: np.ndarray, lens: np.ndarray, lexicon: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Feature ids with their words, for each kind of feature, and the words' hashes."""
    n = len(lens)
    padded = lens + 2
    ends = np.cumsum(padded)
    c = np.full(int(padded.sum()) + 3, 1, np.uint32)  # 1 closes a word
    word = np.repeat(np.arange(n, dtype=np.int32), padded)
    inner = np.ones(len(word), bool)
    inner[ends - 1] = inner[ends - padded] = False
    c[:len(word)][inner] = letters
    c[ends - padded] = 0                              # 0 opens a word
    left = np.repeat(ends, padded) - np.arange(len(word))   # characters up to the word's end
    shift = np.uint32(32 - HASH_BITS)
    out, h = [], np.zeros(len(word), np.uint32)
    for g in range(1, 5):
        h = (h + c[g - 1:g - 1 + len(word)] + np.uint32(g)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        ok = left >= g
        if g == 1:
            ok &= inner
        if g == 4:  # affixes only
            ok &= (left == padded[word]) | (left == 4)
        out.append((((h[ok] * np.uint32(0x85EBCA6B)) >> shift).astype(np.int32), word[ok]))
    v = (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(29)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(lens) - lens, lens)
    v *= (place.astype(np.uint64) * np.uint64(2) + np.uint64(0xBF58476D1CE4E5B9))
    words = np.add.reduceat(v, np.cumsum(lens) - lens) if n else np.zeros(0, np.uint64)
    at = np.minimum(np.searchsorted(lexicon, words), max(len(lexicon) - 1, 0))
    known = lexicon[at] == words if len(lexicon) else np.zeros(n, bool)
    out.append(((at[known] + (1 << HASH_BITS)).astype(np.int32), np.flatnonzero(known).astype(np.int32)))
    return out, words


def _emissions(feats: list[tuple[np.ndarray, np.ndarray]], n: int, weights: np.ndarray) -> np.ndarray:
    e = np.zeros((n, weights.shape[1]), np.float32)
    for ids, word in feats:
        if len(ids):
            first = np.flatnonzero(np.diff(word, prepend=word[0] - 1))
            e[word[first]] += np.add.reduceat(weights[ids], first, axis=0)
    return e


def _forward_backward(e: np.ndarray, lens: np.ndarray, transitions: np.ndarray, pair: np.ndarray | None = None) -> np.ndarray:
    """Posteriors of every word; chains of ``lens`` words lie one after another.
    ``pair`` collects the expected transitions."""
    k = e.shape[1]
    a = np.exp(transitions)
    x = np.exp(e - e.max(axis=1, keepdims=True)) if len(e) else e
    x = np.maximum(x, 1e-30)
    starts = np.cumsum(lens) - lens
    order = np.argsort(-lens, kind="stable")
    alpha, post = np.empty_like(x), np.empty_like(x)
    for lo in range(0, len(order), 2048):
        rows = order[lo:lo + 2048]
        s, m = starts[rows], lens[rows]
        live = np.searchsorted(-m, -np.arange(int(m[0]) if len(m) else 0), side="left")  # chains longer than t
        cur = None
        for t in range(len(live)):
            at = s[:live[t]] + t
            cur = x[at] / k if t == 0 else (cur[:live[t]] @ a) * x[at]
            cur /= cur.sum(axis=1, keepdims=True)
            alpha[at] = cur
        beta = np.ones((len(rows), k), x.dtype)
        for t in range(len(live) - 1, -1, -1):
            at = s[:live[t]] + t
            b = beta[:live[t]]
            if t + 1 < len(live) and (nxt := live[t + 1]):
                right = x[s[:nxt] + t + 1] * beta[:nxt]
                b[:nxt] = right @ a.T
                b[:nxt] /= b[:nxt].sum(axis=1, keepdims=True)
                if pair is not None:
                    p = alpha[s[:nxt] + t][:, :, None] * a[None] * right[:, None, :]
                    pair += (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            q = alpha[at] * b
            post[at] = q / q.sum(axis=1, keepdims=True)
    return post


# ---------------------------------------------------------------------------
# training
# ---------------------------------------------------------------------------

def sample(docs: DataFrame, docs_per_lang: int, chars: int) -> list[tuple[str, str]]:
    """(lang, text) of at most ``docs_per_lang`` labelled rows a language, those
    with the smallest hashed ids, cut at ``chars`` characters."""
    rows = docs.where("not held_out and lang is not null and text is not null")
    w = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = rows.select("id", "lang").withColumn("r", F.row_number().over(w)).where(F.col("r") <= docs_per_lang).select("id").distinct()
    got = rows.join(F.broadcast(ids), "id", "left_semi").select("id", "lang", F.substring("text", 1, chars).alias("text")).collect()
    return [(r.lang, r.text) for r in sorted(got, key=lambda r: (r.id is None, r.id or 0, r.lang, r.text))]


def train(rows: list[tuple[str, str]], epochs: int = 3, lexicon_size: int = 4000, seed: int = 5) -> Model | None:
    """Fit the field by stochastic gradients on the log-likelihood. None without rows."""
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    rng, k = np.random.default_rng(seed), len(langs)
    letters, lens, doc = _words([t.lower() for _, t in rows])
    label = np.array([langs.index(lang) for lang, _ in rows], np.int64)[doc]
    hashes = _features(letters, lens, np.zeros(0, np.uint64))[1]
    uniq, count = np.unique(hashes, return_counts=True)
    lexicon = np.sort(uniq[np.argsort(-count, kind="stable")[:lexicon_size]])
    offs = np.cumsum(lens) - lens
    # runs of one language, joined to chains
    cuts = [c for c in range(0, len(lens), 16)]
    runs = [np.arange(a, b) for c, d in zip(cuts, [*cuts[1:], len(lens)])
            for a, b in zip(*(lambda e: (e[:-1], e[1:]))([c, *(np.flatnonzero(np.diff(doc[c:d])) + c + 1).tolist(), d])) if a < b]
    weights = np.zeros(((1 << HASH_BITS) + len(lexicon), k), np.float32)
    trans = np.zeros((k, k), np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, trans)]
    step, last = 0, epochs * -(-len(runs) // (4 * 128))
    for _ in range(epochs):
        order = rng.permutation(len(runs))
        # half of the chains keep a language for several runs, half switch at random
        half = len(order) // 2
        order = np.concatenate([order[:half], order[half:][np.argsort(label[[runs[i][0] for i in order[half:]]], kind="stable")]])
        chains = [np.concatenate([runs[i] for i in order[j:j + 4]]) for j in range(0, len(order), 4)]
        for b in (lambda idx: [idx[j:j + 128] for j in range(0, len(idx), 128)])(rng.permutation(len(chains))):
            words = np.concatenate([chains[i] for i in b])
            m = np.array([len(chains[i]) for i in b])
            wl = lens[words]
            pos = np.arange(int(wl.sum())) - np.repeat(np.cumsum(wl) - wl, wl) + np.repeat(offs[words], wl)
            feats, _h = _features(letters[pos], wl, lexicon)
            y = label[words]
            pair = np.zeros((k, k))
            post = _forward_backward(_emissions(feats, len(words), weights), m, trans, pair)
            err = post.copy()
            err[np.arange(len(y)), y] -= 1
            inside = np.ones(len(y), bool)
            inside[np.cumsum(m) - 1] = False
            gold = np.zeros((k, k))
            np.add.at(gold, (y[:-1][inside[:-1]], y[1:][inside[:-1]]), 1)
            gw = np.zeros_like(weights)
            for ids, word in feats:
                for j in range(k):
                    gw[:, j] += np.bincount(ids, weights=err[word, j], minlength=len(weights))
            step += 1
            for param, grad, (m1, m2) in zip((weights, trans), (gw / len(y), ((pair - gold) / len(y)).astype(np.float32)), state):
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad * grad - m2)
                param -= 0.05 * max(0.05, 1 - step / last) * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-4)
    return Model(langs, weights, trans, lexicon)


# ---------------------------------------------------------------------------
# prediction
# ---------------------------------------------------------------------------

def _pieces(texts: Iterator[str]) -> Iterator[tuple[int, str]]:
    """Texts in pieces that end between words."""
    for i, t in enumerate(texts):
        a = 0
        while len(t) - a > PIECE:
            b = a + PIECE
            while b > a + 1 and (t[b - 1].isalpha() and t[b].isalpha()):
                b -= 1
            b = b if b > a + 1 else a + PIECE  # one word of over a million letters
            yield i, t[a:b]
            a = b
        yield i, t[a:]


def predict_texts(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Summed posteriors and words by best label, for each text."""
    k = len(model.langs)
    total, votes = np.zeros((len(texts), k)), np.zeros((len(texts), k), np.int64)
    group, size = [], 0

    def flush() -> None:
        letters, lens, part = _words([p.lower() for _, p in group])
        if len(lens):
            feats, _ = _features(letters, lens, model.lexicon)
            e = _emissions(feats, len(lens), model.weights)
            n = np.bincount(part, minlength=len(group))
            chains = np.concatenate([np.append(np.full(c // SEGMENT, SEGMENT), c % SEGMENT) for c in n])
            post = _forward_backward(e, chains[chains > 0], model.transitions)
            doc = np.array([i for i, _ in group])[part]
            for j in range(k):
                total[:, j] += np.bincount(doc, weights=post[:, j], minlength=len(texts))
            best = post.argmax(axis=1)
            np.add.at(votes, (doc, best), 1)

    for i, p in _pieces(iter(texts)):
        group.append((i, p))
        size += len(p)
        if size >= PIECE:
            flush()
            group, size = [], 0
    if group:
        flush()
    return total, votes


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(2).to_pylist()]
            if model is None:
                pred, score, words = [UNDETERMINED] * len(texts), [0.0] * len(texts), [{}] * len(texts)
            else:
                total, votes = predict_texts(texts, model)
                n = total.sum(axis=1)
                best = total.argmax(axis=1)
                pred = [model.langs[j] if c > 0 else UNDETERMINED for j, c in zip(best, n)]
                score = np.where(n > 0, total.max(axis=1) / np.maximum(n, 1e-9), 0.0).clip(0, 1).tolist()
                words = [{model.langs[j]: int(v[j]) for j in np.flatnonzero(v)} for v in votes]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array([list(w.items()) for w in words], pa.map_(pa.string(), pa.int64()))],
                ["id", "held_out", "lang_pred", "score", "lang_words"])
    return run


def identify(docs: DataFrame, docs_per_lang: int = 150, chars: int = 20_000,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, lang_words) for every row of ``docs``.

    Learns from text and non-null language of rows that are not held out
    (CRC-32 of the id's text modulo 5 is not 0; a null id counts as empty
    text). ``lang_words`` counts the words by their own label. A null text, or
    one without letters, is ``und`` with score 0, as is everything when no row
    is labelled. Ties go to the first language in order. Other columns are
    ignored; an empty table gives an empty one.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = train(sample(rows, docs_per_lang, chars))
    kind = dict(rows.dtypes)["id"]
    out = rows.select("id", "held_out", "text").mapInArrow(
        _predict(model), f"id {kind}, held_out boolean, lang_pred string, score double, lang_words map<string,bigint>")
    return out.withColumnRenamed("id", id_col)


def op3_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("lang_words")


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.3) -> DataFrame:
    """Pipeline stage: documents without a language that holds ``least`` of
    their words' posterior go, so those without words, too. The bound is low
    because text that switches languages is no fault."""
    ship(spark)
    rows = docs.select(F.col("doc_id").alias("id"), (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0).alias("held_out"),
                       F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(sample(rows, 150, 20_000))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for b in batches:
            res = next(_predict(model)(iter([pa.RecordBatch.from_arrays(
                [pa.nulls(b.num_rows, pa.int64()), pa.nulls(b.num_rows, pa.bool_()), b.column(at)], ["id", "held_out", "text"])])))
            ok = np.array([p != UNDETERMINED and s >= least for p, s in zip(res.column(2).to_pylist(), res.column(3).to_pylist())], bool)
            yield b.filter(pa.array(ok))
    names = docs.columns
    return docs.mapInArrow(keep, docs.schema)
