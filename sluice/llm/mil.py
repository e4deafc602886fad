"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded
(shares of character classes, hashed byte pairs, repetition and word shape),
passed through a learned layer, and weighted by a gated attention

    a = softmax(w . (tanh(V h) * sigmoid(U h)))

learned from document labels alone; the weighted sum of the passages is scored
by a logistic layer. Training is a small numpy loop over a bounded sample of
labelled documents; scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, settle, unpacked

#: Words of a passage, hashed byte pairs, hidden and attention units.
PASSAGE_WORDS, PAIRS, HIDDEN, GATE = 64, 96, 32, 16
#: At most this many labelled documents are trained on.
TRAIN_DOCS = 4000

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_CLASSES = 11


def _class_table() -> np.ndarray:
    out = np.full(256, 10)  # other punctuation and control characters
    for kind, members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789",
                                    b"#*$%&|<>", b"!?", b".,;:", b"\n", b" \t\v\f\r", b"'\"()[]{}-")):
        out[list(members)] = kind
    out[128:] = 9
    return out


_CLASS = _class_table()
_PAIR = np.random.default_rng(11).integers(0, PAIRS, 1 << 16)
WIDTH = _CLASSES + PAIRS + 6


def encode(text: str | None) -> np.ndarray:
    """One row per passage of a whole text; an empty text is one empty passage."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    if not words:
        return np.zeros((1, WIDTH), dtype=np.float32)
    byte = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[byte]
    start = ~space
    start[1:] &= space[:-1]
    count = max(1, round(len(words) / PASSAGE_WORDS))
    of_word = np.minimum(np.arange(len(words)) // PASSAGE_WORDS, count - 1)
    of_byte = of_word[np.maximum(np.cumsum(start) - 1, 0)]
    size = np.bincount(of_byte, minlength=count)[:, None].astype(np.float64)
    kinds = np.bincount(of_byte * _CLASSES + _CLASS[byte], minlength=count * _CLASSES).reshape(count, -1) / size
    both = byte[:-1].astype(np.int64) << 8 | byte[1:]
    pairs = np.bincount(of_byte[1:] * PAIRS + _PAIR[both], minlength=count * PAIRS).reshape(count, -1) / size
    # Repetition: words seen before in the text, and words in 3-word windows that recur in it.
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words])
    seen = np.ones(len(ids), dtype=bool)
    seen[np.unique(ids, return_index=True)[1]] = False
    again = np.zeros(len(ids), dtype=bool)
    if len(ids) > 3:
        first = np.unique(ids[:-2] * len(index) + ids[1:-1], return_inverse=True)[1]
        _, window, times = np.unique(first * len(index) + ids[2:], return_inverse=True, return_counts=True)
        hit = times[window] > 1
        for shift in range(3):
            again[shift:len(ids) - 2 + shift] |= hit
    n = np.bincount(of_word, minlength=count).astype(np.float64)
    length = np.fromiter(map(len, words), np.float64, len(words))
    mean = np.bincount(of_word, length, count) / n
    spread = np.sqrt(np.maximum(np.bincount(of_word, length ** 2, count) / n - mean ** 2, 0))
    rest = np.column_stack([np.bincount(of_word, seen, count) / n, np.bincount(of_word, again, count) / n,
                            mean / 10, spread / 10, np.log1p(n) / 5, np.full(count, math.log1p(len(words)) / 10)])
    return np.hstack([np.sqrt(kinds), np.sqrt(pairs), rest]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights of the network, and mean and scale of the inputs."""
    weights: dict[str, np.ndarray]
    shift: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Activations for passages ``x`` of documents that begin at ``starts``."""
        w = self.weights
        x = np.clip((x - self.shift) / self.scale, -6, 6)
        h = np.tanh(x @ w["W"] + w["b"])
        t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (t * s) @ w["w"]
        doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        e = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        a = e / np.add.reduceat(e, starts)[doc]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "doc": doc, "p": _sigmoid(z @ w["c"] + w["d"])}

    def score(self, text: str | None) -> float:
        return float(self.forward(encode(text), np.zeros(1, dtype=np.int64))["p"][0])


def _gradient(m: Model, f: dict[str, np.ndarray], y: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted log loss, by hand through the attention."""
    w, h, t, s, a, doc = m.weights, f["h"], f["t"], f["s"], f["a"], f["doc"]
    out = (f["p"] - y) * weight / weight.sum()
    dz = out[:, None] * w["c"]
    da = (dz[doc] * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, starts)[doc])
    dgate = de[:, None] * w["w"]
    dt, ds = dgate * s * (1 - t * t), dgate * t * s * (1 - s)
    dh = (a[:, None] * dz[doc] + dt @ w["V"].T + ds @ w["U"].T) * (1 - h * h)
    return {"W": f["x"].T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de,
            "c": f["z"].T @ out, "d": np.array(out.sum())}


def train(bags: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, seed: int = 1,
          epochs: int = 30, batch: int = 64, rate: float = 3e-3, decay: float = 1e-4) -> Model:
    """Adam on document labels. Needs at least one document of each label."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    shape = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": ()}
    start = {k: np.asarray(rng.normal(0, 1 / math.sqrt(max(1, s[0] if s else 1)), s)) * (k not in "bd") for k, s in shape.items()}
    model = Model(start, every.mean(axis=0), every.std(axis=0) + 1e-3)
    first, second = ({k: np.zeros(s) for k, s in shape.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for some in np.array_split(order, max(1, len(order) // batch)):
            starts = np.concatenate([[0], np.cumsum([len(bags[i]) for i in some])[:-1]]).astype(np.int64)
            f = model.forward(np.concatenate([bags[i] for i in some]), starts)
            step += 1
            pace = rate * (1 + math.cos(math.pi * epoch / epochs)) / 2
            for k, g in _gradient(model, f, labels[some], weight[some], starts).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                model.weights[k] = model.weights[k] - pace * (move + decay * model.weights[k])
    return model


def held_out(key: Column) -> Column:
    """Documents whose labels are never learned: crc32 of the key's text mod 3 is 1."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        train_docs: int = TRAIN_DOCS, seed: int = 1) -> Model | float:
    """A model fitted to at most ``train_docs`` labelled documents that are not
    held out, chosen by a hash of the key, as many of each label as there are
    up to half; weights restore the labels' shares. Where only one label
    occurs, its value; without labels 0.5.

    A document with several labels takes the largest; a null label is none.
    """
    marks = (labels.select(F.col(key).alias("k"), F.col("quality").cast("int").alias("label"))
             .filter("k is not null and label in (0, 1)").filter(~held_out(F.col("k")))
             .groupBy("k").agg(F.max("label").alias("label")))
    marks = settle(marks, "train-labels")
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    by_hash = F.xxhash64(F.lit(seed), "k")
    chosen = marks.filter("false")
    for label in (0, 1):
        chosen = chosen.union(marks.filter(F.col("label") == label).orderBy(by_hash, "k").limit(train_docs // 2))
    chosen = settle(chosen, "train-sample")
    # Texts of the chosen keys; of rows that repeat a key the one with the smallest hash counts, before encoding.
    rows = (docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("t"))
            .join(F.broadcast(chosen), F.col("doc") == F.col("k"))  # at most train_docs rows
            .groupBy("k", "label").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
            .select("k", "label", bags_of("t").alias("bag")))
    got = rows.orderBy("k").toPandas()
    if got["label"].nunique() < 2:
        return float(got["label"].iloc[0]) if len(got) else 0.5
    bags = [np.frombuffer(b, dtype=np.float16).astype(np.float32).reshape(-1, WIDTH) for b in got["bag"]]
    y = got["label"].to_numpy(dtype=np.float64)
    used = {v: max(1, int((y == v).sum())) for v in (0, 1)}
    weight = np.array([counts[int(v)] / used[int(v)] for v in y])
    return train(bags, y, weight / weight.mean(), seed)


@F.pandas_udf(T.BinaryType())
def bags_of(texts: pd.Series) -> pd.Series:
    return pd.Series([encode(t).astype(np.float16).tobytes() for t in texts])


def score(docs: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good likelier). Only the text is
    looked at. Defined cases: null and empty texts are an empty passage;
    repeated rows score alike; an input column named ``score`` is replaced."""
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([model if isinstance(model, float) else model.score(t) for t in texts], dtype="float64")

    out = docs.select(packed(docs), of(F.col(f"`{text}`")).alias("score"))
    return out.select(*unpacked(out, docs.columns, ("score",)), "score")
