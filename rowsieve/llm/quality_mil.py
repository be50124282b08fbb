"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE_WORDS`` words each, the last may be shorter).
Only documents have labels. Every passage is encoded; a gated attention gives each a
weight, the weighted mean of the encodings represents the document, and a logistic unit
scores it. Encoder, attention and score are learned together.

Inputs of the encoder, all from the text: shares of byte classes, word shapes, repeated
words within the passage and repeated lines and word runs within the document, and a
hashed histogram of byte trigrams.

The model is learned from a bounded sample: ``SAMPLE_DOCUMENTS`` labelled documents, the
first in the order of a hash of the id, and ``SAMPLE_PASSAGES`` evenly spaced passages of
each. That bounds what the driver gets. Scoring takes all passages of all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.llm.common import lean, spans, text_bytes
from rowsieve.llm.words import Words, mix

PASSAGE_WORDS = 64
SAMPLE_DOCUMENTS = 4000
SAMPLE_PASSAGES = 32
THRESHOLD = 0.3

_TRIGRAM_BUCKETS = 64
_HIDDEN, _GATE = 24, 12
_STEPS, _RATE, _DECAY = 150, 0.03, 1e-4

# Byte classes: small letters, capitals, digits, white space, each mark that is common in
# damaged text, other ASCII marks, and bytes of letters beyond ASCII.
_MARKS = b"#$%&*|!?.,;:-_<>{}[]()=+~^@/\\\"'"
_CLASS = np.full(256, 5 + len(_MARKS), dtype=np.uint8)
_CLASS[:128] = 4
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[list(b" \t\n\x0b\x0c\r")] = 3
for _i, _b in enumerate(_MARKS):
    _CLASS[_b] = 5 + _i
_CLASSES = 6 + len(_MARKS)
_SHAPES = 10
N_FEATURES = _CLASSES + _SHAPES + _TRIGRAM_BUCKETS


def passages(texts: list[bytes], size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of some texts, and the bounds of each text's passages.

    A text without words has one passage of zeros.
    """
    words = Words(texts)
    n_words = np.diff(words.bounds)
    counts = np.maximum(1, -(-n_words // size))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = int(bounds[-1])
    out = np.zeros((total, N_FEATURES), dtype=np.float32)
    n = len(words.hashes)
    if not n:
        return out, bounds
    text_of = np.repeat(np.arange(len(texts)), n_words)
    within = np.arange(n) - words.bounds[:-1][text_of]
    passage = bounds[:-1][text_of] + within // size
    per = np.bincount(passage, minlength=total)
    some = np.maximum(per, 1)

    # Byte classes and trigrams: each byte belongs to the passage of the word before it in
    # its text; what stands before the first word of a text counts for none.
    byte_word = np.searchsorted(words.starts, np.arange(len(words.raw)), side="right") - 1
    byte_text = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
    inside = (byte_word >= 0) & (text_of[byte_word] == byte_text)
    inside[words.offsets[1:] - 1] = False  # the end of each text, which is not part of it
    byte_passage = passage[byte_word]
    shares = np.bincount(
        byte_passage[inside] * _CLASSES + _CLASS[words.raw[inside]], minlength=total * _CLASSES
    )
    shares = shares.reshape(total, _CLASSES).astype(np.float32)
    n_bytes = np.maximum(shares.sum(axis=1, keepdims=True), 1)
    out[:, :_CLASSES] = np.sqrt(shares / n_bytes)
    raw = words.raw.astype(np.uint32)
    grams = ((raw[:-2] * 961 + raw[1:-1] * 31 + raw[2:]) * np.uint32(2654435761)) >> np.uint32(26)
    three = inside[:-2] & inside[1:-1] & inside[2:]
    hist = np.bincount(
        byte_passage[:-2][three] * _TRIGRAM_BUCKETS + grams[three], minlength=total * _TRIGRAM_BUCKETS
    )
    out[:, -_TRIGRAM_BUCKETS:] = np.sqrt(hist.reshape(total, _TRIGRAM_BUCKETS) / n_bytes)

    # Word shapes and repeats.
    lengths = (words.ends - words.starts).astype(np.float64)
    mean = np.bincount(passage, lengths, total) / some
    spread = np.sqrt(np.maximum(np.bincount(passage, lengths**2, total) / some - mean**2, 0))
    first, last = _CLASS[words.raw[words.starts]], _CLASS[words.raw[words.ends - 1]]
    same_text = text_of[1:] == text_of[:-1]
    twice = np.concatenate([[False], same_text & (words.hashes[1:] == words.hashes[:-1])])
    seen = _repeats(mix(words.hashes ^ mix(passage.astype(np.uint64))))
    # Runs of three words, not across texts; the last two words of a text begin none.
    run = words.hashes.copy()
    run[:-2] = mix(mix(run[:-2] + np.uint64(1) + words.hashes[1:-1]) + words.hashes[2:])
    whole = np.zeros(n, dtype=bool)
    whole[:-2] = text_of[2:] == text_of[:-2]
    again = np.zeros(n, dtype=bool)
    again[whole] = _repeats((run ^ mix(text_of.astype(np.uint64)))[whole])
    lines = _line_repeats(words, text_of)
    shape = [
        mean / 10,
        spread / 10,
        np.bincount(passage, first == 1, total) / some,
        np.bincount(passage, last >= 4, total) / some,
        np.bincount(passage, (words.ends - words.starts) == 1, total) / some,
        np.bincount(passage, twice, total) / some,
        np.bincount(passage, seen, total) / some,
        np.bincount(passage, again, total) / some,
        np.bincount(passage, lines, total) / some,
        np.log1p(per) / 5,
    ]
    out[:, _CLASSES : _CLASSES + _SHAPES] = np.stack(shape, axis=1)
    return out, bounds


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur before in the array."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def _line_repeats(words: Words, text_of: np.ndarray) -> np.ndarray:
    """Which words stand in a line that an earlier line of the text equals."""
    feeds = np.concatenate([[0], np.cumsum(words.raw == 10)])
    line = feeds[words.starts]
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    place = np.arange(len(line)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(line)]])))
    sums = np.add.reduceat(mix(words.hashes + place.astype(np.uint64)), starts)
    old = _repeats(mix(sums) ^ mix(text_of[starts].astype(np.uint64)))
    return np.repeat(old, np.diff(np.concatenate([starts, [len(line)]])))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Scores from 0 to 1 of texts given as passages."""
        return _forward(self.weights, (features - self.mean) * self.scale, bounds)["score"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    starts = bounds[:-1]
    bag = np.repeat(np.arange(len(starts)), np.diff(bounds))
    h = np.tanh(x @ w["enc"] + w["enc0"])
    t, g = np.tanh(h @ w["att"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    # The logit is at most the sum of |pick|, so its exponential needs no shift.
    e = np.exp((t * g) @ w["pick"])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    logit = np.clip(z @ w["out"] + w["out0"], -30, 30)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "score": 1 / (1 + np.exp(-logit))}


def fit(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Learn from passages and document labels by full-batch Adam steps."""
    mean = features.mean(axis=0)
    scale = 1 / (features.std(axis=0) + 1e-3)
    x = ((features - mean) * scale).astype(np.float32)
    y = labels.astype(np.float32)
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    w = {
        "enc": rng.normal(0, d**-0.5, (d, _HIDDEN)),
        "enc0": np.zeros(_HIDDEN),
        "att": rng.normal(0, 0.2, (_HIDDEN, _GATE)),
        "gate": rng.normal(0, 0.2, (_HIDDEN, _GATE)),
        "pick": rng.normal(0, 0.2, _GATE),
        "out": rng.normal(0, 0.2, _HIDDEN),
        "out0": np.array(0.0),
    }
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, _STEPS + 1):
        for k, grad in _gradients(w, x, bounds, y).items():
            grad = grad + _DECAY * w[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            rate = _RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            w[k] = (w[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return Model(mean.astype(np.float32), scale.astype(np.float32), w)


def _gradients(w, x, bounds, y) -> dict[str, np.ndarray]:
    """Of the mean log loss."""
    f = _forward(w, x, bounds)
    starts, bag = bounds[:-1], f["bag"]
    d_logit = (f["score"] - y) / len(y)
    d_z = d_logit[:, None] * w["out"]
    d_a = np.einsum("ij,ij->i", d_z[bag], f["h"])
    mean_a = np.add.reduceat(f["a"] * d_a, starts)
    d_s = f["a"] * (d_a - mean_a[bag])
    d_tg = d_s[:, None] * w["pick"]
    d_t = d_tg * f["g"] * (1 - f["t"] ** 2)
    d_g = d_tg * f["t"] * f["g"] * (1 - f["g"])
    d_h = f["a"][:, None] * d_z[bag] + d_t @ w["att"].T + d_g @ w["gate"].T
    d_pre = d_h * (1 - f["h"] ** 2)
    return {
        "enc": x.T @ d_pre,
        "enc0": d_pre.sum(axis=0),
        "att": f["h"].T @ d_t,
        "gate": f["h"].T @ d_g,
        "pick": (f["t"] * f["g"]).T @ d_s,
        "out": f["z"].T @ d_logit,
        "out0": d_logit.sum(),
    }


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from ``docs (doc_id, text)`` and ``labels (doc_id, label 0 or 1)``.

    Rows with nulls are left out; of several labels of a document the largest counts.
    Without a document of each label there is nothing to learn, and the result is None.
    """
    known = labels.where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                x, bounds = passages(text_bytes(part.column("text")))
                kept = [_spaced(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                bags = [x[k].astype(np.float32).tobytes() for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(bags, pa.binary())],
                    names=["doc_id", "label", "bag"],
                )

    # The sample is bounded, so it may be sent to all tasks.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = rows.select(F.col("doc_id").cast("long"), F.col("label").cast("int"), "text")
    found = rows.mapInArrow(encode, "doc_id long, label int, bag binary").toArrow().sort_by("doc_id")
    y = found.column("label").to_numpy()
    if len(set(y)) < 2:
        return None
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, N_FEATURES) for b in found.column("bag").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return fit(np.concatenate(bags), bounds, y)


def _spaced(lo: int, hi: int) -> np.ndarray:
    if hi - lo <= SAMPLE_PASSAGES:
        return np.arange(lo, hi)
    return np.linspace(lo, hi - 1, SAMPLE_PASSAGES).astype(int)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` and their ``score`` (double, 0 to 1).

    Every passage of every text counts. Null and empty texts have one empty passage.
    Without a model every score is 0.5. Other columns stay; one named ``score`` is
    replaced.
    """
    docs = docs.drop("score")
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                x, bounds = passages(text_bytes(part.column("text")))
                scores = model.score(x, bounds).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores)], names=[*part.schema.names, "score"]
                )

    return docs.mapInArrow(lean(run), schema)
