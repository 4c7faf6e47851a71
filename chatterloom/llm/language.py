"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``WINDOW`` bytes; nothing is left out. In each window a gated recurrent unit reads the
bytes forwards, another backwards; from both states every position gets a probability for each language. The
probabilities of all positions of a document are averaged: the largest is the prediction, its value the score.

The network is trained here, in numpy, by backpropagation through time and Adam, on windows drawn from the whole texts
of a bounded sample: at most ``sample_docs`` documents a language (the smallest hashes of their ids) and
``sample_windows`` windows of each. Only text and label are used.

A null text, or one without a letter, is ``und`` with score 0. Rows that repeat get equal results. With no labelled
document, every prediction is ``und``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterloom.llm.common import map_arrow, map_pandas, without

WINDOW = 64
HIDDEN = 8
UNKNOWN = "und"


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


# Network: arrays are (units, windows), so that a step works on contiguous rows.


@dataclass
class Model:
    labels: list[str]
    weights: dict[str, np.ndarray]


def _initial(labels: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    weights = {"c": np.zeros((labels, 1))}
    for d in "fb":
        weights["x" + d] = rng.normal(0, 0.3, (3 * HIDDEN, 256))  # gates by byte: update, reset, candidate
        weights["a" + d] = np.zeros((3 * HIDDEN, 1))
        weights["u" + d] = rng.normal(0, 1 / np.sqrt(HIDDEN), (3 * HIDDEN, HIDDEN))
        weights["v" + d] = rng.normal(0, 0.3, (labels, HIDDEN))
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _step(table: np.ndarray, u: np.ndarray, codes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step: update gate, reset gate, recurrent part of the candidate, candidate, new state."""
    x, s = np.take(table, codes, axis=1), u @ h
    gates = _sigmoid(x[: 2 * HIDDEN] + s[: 2 * HIDDEN])
    z, r, q = gates[:HIDDEN], gates[HIDDEN:], s[2 * HIDDEN :]
    n = np.tanh(x[2 * HIDDEN :] + r * q)
    return z, r, q, n, n + z * (h - n)


def _softmax(logits: np.ndarray, axis: int = 0) -> np.ndarray:
    np.exp(logits - logits.max(axis=axis, keepdims=True), out=logits)
    logits /= logits.sum(axis=axis, keepdims=True)
    return logits


def position_probabilities(weights: dict[str, np.ndarray], codes: np.ndarray, there: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each position of the windows (time x windows), the probabilities (labels x windows).

    ``there`` is 1 for bytes, 0 for padding behind them; the backward state starts behind the padding.
    """
    time, n = codes.shape
    tables = {d: weights["x" + d] + weights["a" + d] for d in "fb"}
    back = np.empty((time, HIDDEN, n), np.float32)
    h = np.zeros((HIDDEN, n), np.float32)
    for t in reversed(range(time)):
        h = _step(tables["b"], weights["ub"], codes[t], h)[-1]
        if not there[t].all():
            h = h * there[t]
        back[t] = h
    h = np.zeros((HIDDEN, n), np.float32)
    for t in range(time):
        h = _step(tables["f"], weights["uf"], codes[t], h)[-1]
        yield t, _softmax(weights["vf"] @ h + weights["vb"] @ back[t] + weights["c"])


def _gradients(weights: dict[str, np.ndarray], codes: np.ndarray, there: np.ndarray, truth: np.ndarray):
    """Loss and gradients of the mean cross entropy over all positions, by backpropagation through time."""
    time, n = codes.shape
    order = {"f": list(range(time)), "b": list(reversed(range(time)))}
    tape: dict[str, list] = {"f": [None] * time, "b": [None] * time}
    states = {d: np.empty((time, HIDDEN, n), np.float32) for d in "fb"}
    for d in "fb":
        table, h = weights["x" + d] + weights["a" + d], np.zeros((HIDDEN, n), np.float32)
        for t in order[d]:
            *parts, new = _step(table, weights["u" + d], codes[t], h)
            tape[d][t] = (h, *parts)
            h = new * there[t]
            states[d][t] = h
    logits = np.einsum("lh,thn->tln", weights["vf"], states["f"]) + np.einsum("lh,thn->tln", weights["vb"], states["b"])
    p = _softmax(logits + weights["c"], axis=1)
    total = there.sum()
    loss = -(np.log(p[:, truth, np.arange(n)] + 1e-9) * there).sum() / total
    error = p
    error[:, truth, np.arange(n)] -= 1
    error *= there[:, None, :] / total
    grads = {"c": error.sum(axis=(0, 2))[:, None]}
    for d in "fb":
        u = weights["u" + d]
        grads["v" + d] = np.einsum("tln,thn->lh", error, states[d])
        into = np.einsum("lh,tln->thn", weights["v" + d], error)
        du, dx, flow = np.zeros_like(u), np.zeros_like(weights["x" + d]), np.zeros((HIDDEN, n), np.float32)
        for t in reversed(order[d]):
            h, z, r, q, c = tape[d][t]
            g = (flow + into[t]) * there[t]
            dn = g * (1 - z) * (1 - c * c)
            step = np.concatenate([g * (h - c) * z * (1 - z), dn * q * r * (1 - r), dn])
            inner = np.concatenate([step[: 2 * HIDDEN], dn * r])
            du += inner @ h.T
            flow = g * z + u.T @ inner
            for row in range(3 * HIDDEN):
                dx[row] += np.bincount(codes[t], step[row], 256)
        grads["u" + d], grads["x" + d], grads["a" + d] = du, dx, dx.sum(axis=1, keepdims=True)
    return loss, grads


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: bytes and presence (time x windows), and each window's text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    per = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), per)
    first = np.concatenate(([0], np.cumsum(per)))[:-1] * WINDOW
    grid = np.zeros(int(per.sum()) * WINDOW, np.uint8)
    there = np.zeros(len(grid), np.bool_)
    for at, text in zip(first.tolist(), texts, strict=True):
        grid[at : at + len(text)] = np.frombuffer(text, np.uint8)
        there[at : at + len(text)] = True
    shape = (-1, WINDOW)
    return np.ascontiguousarray(grid.reshape(shape).T), np.ascontiguousarray(there.reshape(shape).T), owner


def train(samples: list[tuple[str, bytes]], *, steps: int = 260, batch: int = 192, rate: float = 0.02, seed: int = 5) -> Model:
    """``samples`` are windows with their language; batches hold as many of each language."""
    labels = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    weights = _initial(len(labels), rng)
    if len(labels) < 2:
        return Model(labels, weights)
    groups = [[w for lang, w in sorted(samples) if lang == label] for label in labels]
    each = max(batch // len(labels), 8)
    mean, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    for step in range(1, steps + 1):
        drawn = [g[i] for g in groups for i in rng.integers(0, len(g), each)]
        codes, there, owner = _windows(drawn)
        truth = (owner // each).astype(np.int64)
        _, grads = _gradients(weights, codes.astype(np.int64), there.astype(np.float32), truth)
        scale = min(1.0, 1.0 / (np.sqrt(sum(float((g * g).sum()) for g in grads.values())) + 1e-9))
        pace = rate * (1 - step / (steps + 1))
        for k, g in grads.items():
            g = g * scale
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            update = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
            weights[k] = (weights[k] - pace * update).astype(np.float32)
    return Model(labels, weights)


def document_probabilities(model: Model, texts: list[bytes], block: int = 2048) -> np.ndarray:
    """Texts x labels: the average over all positions."""
    codes, there, owner = _windows(texts)
    total = np.zeros((len(texts), len(model.labels)))
    for low in range(0, codes.shape[1], block):
        part, here = np.ascontiguousarray(codes[:, low : low + block]), there[:, low : low + block]
        pooled = np.zeros((len(model.labels), part.shape[1]), np.float32)
        full = here.all(axis=1)
        for t, p in position_probabilities(model.weights, part, here):
            pooled += p if full[t] else p * here[t]
        np.add.at(total, owner[low : low + block], pooled.T)
    return total / np.maximum([[len(t)] for t in texts], 1)


# Spark


def training_windows(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int, sample_windows: int
) -> list[tuple[str, bytes]]:
    """The bounded sample, cut into windows by the tasks: labels x ``sample_docs`` x ``sample_windows`` at most."""
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    narrow = usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    picked = narrow.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample_docs)
    chosen = usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chosen = chosen.join(picked.select("id", "lang").distinct(), ["id", "lang"], "left_semi")

    def cut(batches):
        for batch in batches:
            out = []
            for key, lang, text in zip(batch["id"], batch["lang"], batch["text"], strict=True):
                raw = text.encode("utf-8", "replace")
                rng = np.random.default_rng(zlib.crc32(str(key).encode()))
                starts = rng.integers(0, max(len(raw) - WINDOW, 0) + 1, sample_windows)
                out += [(lang, raw[s : s + WINDOW]) for s in sorted(set(starts.tolist())) if raw]
            yield pd.DataFrame(out, columns=["lang", "piece"])

    return [(r[0], bytes(r[1])) for r in map_pandas(chosen, cut, "lang string, piece binary").collect()]


def fit(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 200,
    sample_windows: int = 8, **training,
) -> Model:
    return train(training_windows(docs, id_col, text_col, lang_col, sample_docs, sample_windows), **training)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``lang_pred`` and ``score`` (which replace columns of these names)."""
    docs = without(docs, "lang_pred", "score") if text_col not in ("lang_pred", "score") else docs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            known = [i for i, t in enumerate(texts) if _has_letter(t)] if model.labels else []
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                # Equal texts of a batch are read once.
                unique = {texts[i]: None for i in known}
                found = document_probabilities(model, [t.encode("utf-8", "replace") for t in unique])
                place = {t: k for k, t in enumerate(unique)}
                for i in known:
                    p = found[place[texts[i]]]
                    pred[i], score[i] = model.labels[int(p.argmax())], float(min(max(p.max(), 0.0), 1.0))
            out = pa.Table.from_batches([batch])
            out = out.append_column("lang_pred", pa.array(pred, pa.string())).append_column("score", pa.array(score, pa.float64()))
            yield from out.to_batches()

    schema = docs.schema.simpleString()[len("struct<") : -1] + ",lang_pred:string,score:double"
    return map_arrow(docs, work, schema)
