"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (``WORDS`` words each). Every passage is encoded from the
shares of its byte classes and class pairs by a learned layer; gated attention
``w . (tanh(V h) * sigmoid(U h))`` weighs the passages of a document, and a logistic unit scores
their weighted mean. Only document labels are used: gradients reach the passages through the
attention weights.

Training runs on the driver over a bounded sample (``SAMPLE_DOCS`` documents and
``SAMPLE_BYTES`` bytes of text at most, in hash order of the id, texts over a ``SHARE``-th of
those bytes last); scoring is one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import held_out, slices

WORDS = 64
SAMPLE_DOCS = 4000
SAMPLE_BYTES = 48 << 20
SHARE = 64
THRESHOLD = 0.7
HIDDEN, GATE, EPOCHS, BATCH, RATE = 32, 16, 30, 64, 0.01
_BLANKS = b"\t\n\x0b\x0c\r "


def _classes() -> tuple[np.ndarray, int, np.ndarray, int]:
    """Fine class of each byte (every ASCII mark its own) and coarse class for pairs."""
    fine = np.zeros(256, np.int64)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        fine[b] = (1 if b < 128 and c in "aeiou" else 2 if b < 128 and c.islower() else
                   3 if b < 128 and c.isupper() else 4 if b < 128 and c.isdigit() else
                   5 if c == " " else 6 if c == "\n" else 7 if b in _BLANKS else
                   8 if b >= 192 else 9 if b >= 128 else 0)
    for i, b in enumerate(marks):
        fine[b] = 10 + i
    coarse = np.minimum(fine, 10)
    for i, c in enumerate(".,|"):
        coarse[ord(c)] = 11 + i
    return fine, int(fine.max()) + 1, coarse, int(coarse.max()) + 1


FINE, N_FINE, COARSE, N_COARSE = _classes()
FEATURES = N_FINE + N_COARSE * N_COARSE + 2


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and the number of passages of each text (one at least:
    an empty text has one passage of zeros)."""
    # a blank after each text keeps words apart
    raw = [(t or "").encode("utf-8", "replace") + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    begins = ends - [len(r) for r in raw]
    blank = np.zeros(256, bool)
    blank[list(_BLANKS)] = True
    word = ~blank[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    start[begins] = word[begins]
    nth = np.cumsum(start)
    before = nth[begins] - start[begins]
    own = np.repeat(before, np.diff(np.r_[begins, len(data)]))
    ordinal = np.maximum(nth - own - 1, 0) // WORDS
    words = nth[ends - 1] - before
    n = np.maximum(1, -(-words // WORDS))
    first = np.cumsum(n) - n
    passage = ordinal + np.repeat(first, np.diff(np.r_[begins, len(data)]))
    total = int(n.sum())
    fine = np.bincount(passage * N_FINE + FINE[data], minlength=total * N_FINE)
    pair = COARSE[data[:-1]] * N_COARSE + COARSE[data[1:]]
    inner = np.ones(len(pair), bool)
    inner[ends[:-1] - 1] = False  # the pairs of one text's last byte and the next one's first
    pairs = np.bincount((passage[:-1] * N_COARSE ** 2 + pair)[inner],
                        minlength=total * N_COARSE ** 2)
    fine = fine.reshape(total, N_FINE).astype(np.float32)
    pairs = pairs.reshape(total, N_COARSE ** 2).astype(np.float32)
    size = np.maximum(fine.sum(axis=1, keepdims=True), 1)
    heads = np.bincount(passage, weights=start, minlength=total).reshape(-1, 1)
    x = np.hstack([np.sqrt(fine / size), np.sqrt(pairs / size), heads / WORDS,
                   np.log1p(size / np.maximum(heads, 1)) / 4]).astype(np.float32)
    x[np.repeat(words == 0, n)] = 0
    return x, n


class Model:
    """Passage encoder, gated attention and document score."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float64)
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE),
                  "U": draw(HIDDEN, GATE), "w": draw(GATE, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0],
                  "d": np.zeros(1)}

    def forward(self, x: np.ndarray, n: np.ndarray) -> dict:
        p, at = self.p, np.cumsum(n) - n
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a = e / np.repeat(np.add.reduceat(e, at), n)
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -40, 40)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "score": score, "at": at}

    def gradients(self, f: dict, n: np.ndarray, y: np.ndarray) -> dict:
        p, g = self.p, {}
        delta = (f["score"] - y) / len(y)
        g["c"], g["d"] = f["z"].T @ delta, np.array([delta.sum()])
        dz = np.repeat(delta[:, None] * p["c"], n, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, f["at"]), n))
        g["w"] = (f["t"] * f["s"]).T @ de
        dg = de[:, None] * p["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        g["V"], g["U"] = f["h"].T @ dt, f["h"].T @ ds
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        g["W"], g["b"] = f["x"].T @ dh, dh.sum(axis=0)
        return g

    def fit(self, x: np.ndarray, n: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
        """Adam on the documents' log loss, with a fixed order of batches."""
        rng, at = np.random.default_rng(seed), np.cumsum(n) - n
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.02
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(q) for k, q in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(n))
            for i in range(0, len(order), BATCH):
                docs = order[i:i + BATCH]
                rows = np.concatenate([np.arange(at[k], at[k] + n[k]) for k in docs])
                g = self.gradients(self.forward(x[rows], n[docs]), n[docs], y[docs])
                step += 1
                for k, q in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * q
                    v[k] = 0.999 * v[k] + 0.001 * q * q
                    self.p[k] -= rate * ((m[k] / (1 - 0.9 ** step))
                                         / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                                         + 1e-4 * self.p[k])
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        x, n = passages(texts)
        return self.forward(x, n)["score"]


def fitting(sizes: list[tuple], limit: int) -> list:
    """The keys of ``(key, bytes)`` rows that fit into ``limit`` bytes together, taken in order,
    those over a ``SHARE``-th of the limit after all others. One that does not fit is passed
    over and the next ones are tried."""
    picked, used = [], 0
    for key, size in sorted(sizes, key=lambda r: r[1] > limit // SHARE):
        if used + size <= limit:
            picked.append(key)
            used += size
    return picked


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_docs: int = SAMPLE_DOCS,
          sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model of the labelled rows (label 0 or 1; other labels and null ids are left out; an
    id with several labels counts as their maximum).

    The sample holds whole texts of at most ``sample_docs`` labelled documents and
    ``sample_bytes`` bytes; a text that does not fit is left out alone (see ``fitting``).
    Without a labelled row that fits the model scores everything 0.5, with labels of one kind
    it scores everything near that label.
    """
    wanted = (labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("y"))
              .filter("key is not null and y in (0, 1)").groupBy("key").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("key"), "key").limit(sample_docs))
    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    rows = src.join(F.broadcast(wanted), "key")  # at most sample_docs small rows
    size = F.octet_length(F.coalesce("text", F.lit(""))).alias("size")
    sizes = rows.groupBy("key").agg(F.max(size).alias("size")) \
        .orderBy(F.xxhash64("key"), "key")
    picked = docs.sparkSession.createDataFrame(  # at most sample_docs small rows
        [(k,) for k in fitting([tuple(r) for r in sizes.collect()], sample_bytes)],
        sizes.select("key").schema)
    rows = rows.join(F.broadcast(picked), "key")

    def run(batches):
        for b in slices(batches, 1):
            x, n = passages(b.column(1).to_pylist())
            at = np.cumsum(n) - n
            packed = [x[a:a + k].astype(np.float16).tobytes() for a, k in zip(at, n)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(packed, pa.binary())], ["key", "y", "x"])

    kind = rows.schema["key"].dataType.simpleString()
    got = rows.select("key", "text", "y").mapInArrow(run, f"key {kind}, y int, x binary").collect()
    model = Model()
    if not got:
        model.p["c"][:] = 0
        return model
    got.sort(key=lambda r: (str(r["key"]), bytes(r["x"])))
    bags = [np.frombuffer(r["x"], np.float16).reshape(-1, FEATURES).astype(np.float32) for r in got]
    y = np.array([r["y"] for r in got], np.float64)
    return model.fit(np.vstack(bags), np.array([len(b) for b in bags]), y)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, score, predicted`` of every row; a null text counts as empty and is scored
    too. Ids may be null or repeat; other columns are not read."""

    def run(batches):
        for b in slices(batches, 1, 2 << 20):
            s = model.score(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())],
                                             ["key", "score"])

    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, score double").select(
        F.col("key").alias(id_col), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def evaluate(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learns from labelled rows outside the held-out fold and scores every row: ``doc_id,
    held_out, score, predicted``. Null texts are scored as empty ones, a null id is never held
    out and has no label, repeated rows are scored each, an empty table gives an empty
    result."""
    out = held_out(F.col("doc_id"), folds, fold)
    model = train(docs, labels.filter(~out))
    found = score(docs, model)
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")
