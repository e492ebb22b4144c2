"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads a text in windows of ``WINDOW`` bytes, forwards and backwards; at every position the two states give a
probability of each language, and a document's probabilities are the mean over its positions. It is trained here
in numpy: backpropagation through time on windows of training texts, with Adam.

Fitting reads at most ``TRAIN_DOCS`` texts with a language, the first by a hash of the id, none over ``TRAIN_BYTES``; each
language has the same share of the windows. Prediction reads every text whole, windows of many texts side by side.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without training texts every text is;
rows are judged one by one, so repeated rows and null ids stay, the latter not held out; an empty table gives an
empty result; columns other than doc_id and text (lang when fitting) are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import flat, slices

HIDDEN = 8
WINDOW = 64
TRAIN_DOCS = 4_000
TRAIN_BYTES = 20_000
STEPS, BATCH, RATE = 500, 256, 0.02
# Windows that are read side by side.
TOGETHER = 2_048


def _falling(x: np.ndarray) -> None:
    """1 / (1 + exp(x)) in place; exp runs several numbers at a time where tanh does not."""
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


class Network:
    """Two gated recurrent layers and a softmax. Gates in the order update, reset, candidate."""

    def __init__(self, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        scale = 1 / np.sqrt(HIDDEN)
        self.weights = {
            **{f"in{d}": rng.normal(0, 0.5, (256, 3 * HIDDEN)).astype(np.float32) for d in (0, 1)},
            **{f"state{d}": rng.normal(0, scale, (HIDDEN, 3 * HIDDEN)).astype(np.float32) for d in (0, 1)},
            "out": rng.normal(0, scale, (2 * HIDDEN, len(languages))).astype(np.float32),
            "bias": np.zeros(len(languages), np.float32),
        }

    def _states(self, windows: np.ndarray, direction: int, keep: list | None = None) -> np.ndarray:
        """State at every position, (time, window, unit); ``keep`` gets what the backward pass needs.

        Each gate has an array of its own, so that every operation runs over unbroken memory. The signs and the factor
        with which ``_falling`` gives the gates and the hyperbolic tangent are taken into the weights.
        """

        def scaled(name: str) -> list[np.ndarray]:
            whole = self.weights[f"{name}{direction}"]
            return [np.ascontiguousarray(whole[:, i * HIDDEN : (i + 1) * HIDDEN]) * whole.dtype.type(f) for i, f in enumerate((-1, -1, -2))]

        tables, matrices = scaled("in"), scaled("state")
        n, steps, kind = len(windows), windows.shape[1], tables[0].dtype
        columns = np.ascontiguousarray(windows.T, np.intp)
        states = np.empty((steps, n, HIDDEN), kind)
        state = np.zeros((n, HIDDEN), kind)
        given, update, reset, carried, candidate = np.empty((5, n, HIDDEN), kind)
        for step in range(steps)[:: -1 if direction else 1]:
            for gate, table, matrix in zip((update, reset), tables, matrices):
                np.matmul(state, matrix, out=gate)
                np.take(table, columns[step], axis=0, out=given, mode="clip")
                gate += given
                _falling(gate)
            np.matmul(state, matrices[2], out=carried)
            np.take(tables[2], columns[step], axis=0, out=given, mode="clip")
            np.multiply(reset, carried, out=candidate)
            candidate += given
            _falling(candidate)
            candidate *= 2
            candidate -= 1
            if keep is not None:
                keep.append((step, state, np.concatenate([update, reset], axis=1), carried * -0.5, candidate.copy()))
            # The update gate says how much of the old state stays.
            after = states[step]
            np.subtract(state, candidate, out=after)
            after *= update
            after += candidate
            state = after
        return states

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Probability of each language at every position, (language, time, window)."""
        out = self.weights["out"]
        logits = sum(out[d * HIDDEN : (d + 1) * HIDDEN].T @ self._states(windows, d).reshape(-1, HIDDEN).T for d in (0, 1))
        logits += self.weights["bias"][:, None]
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits.reshape(len(logits), windows.shape[1], len(windows))

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradients by backpropagation through time."""
        kept: tuple[list, list] = [], []
        both = np.concatenate([self._states(windows, d, kept[d]) for d in (0, 1)], axis=2)
        steps, n, _ = both.shape
        logits = both @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        loss = -float(np.log(np.maximum(p[:, np.arange(n), labels], 1e-9)).mean())
        p[:, np.arange(n), labels] -= 1
        p /= steps * n
        out = {
            "out": np.tensordot(both, p, axes=([0, 1], [0, 1])), "bias": p.sum(axis=(0, 1)),
            **{k: np.zeros_like(v) for k, v in self.weights.items() if k[:2] in ("in", "st")},
        }
        to_states = p @ self.weights["out"].T
        for d in (0, 1):
            matrix = self.weights[f"state{d}"]
            # In the order of reading; what does not depend on later steps is taken for all steps at once.
            order, *values = zip(*kept[d])
            before, gates, inner, candidate = map(np.stack, values)
            update, reset = gates[:, :, :HIDDEN].copy(), gates[:, :, HIDDEN:].copy()
            by_candidate = (1 - update) * (1 - candidate**2)
            by_update = (before - candidate) * update * (1 - update)
            by_reset = by_candidate * inner * reset * (1 - reset)
            by_inner = by_candidate * reset
            carry, back = np.zeros((n, HIDDEN), p.dtype), np.ascontiguousarray(matrix.T)
            slopes, carried = np.empty((2, steps, n, 3 * HIDDEN), p.dtype)
            for i in reversed(range(steps)):
                slope = to_states[order[i], :, d * HIDDEN : (d + 1) * HIDDEN] + carry
                at = carried[i]
                np.multiply(slope, by_update[i], out=at[:, :HIDDEN])
                np.multiply(slope, by_reset[i], out=at[:, HIDDEN : 2 * HIDDEN])
                np.multiply(slope, by_inner[i], out=at[:, 2 * HIDDEN :])
                np.multiply(slope, by_candidate[i], out=slopes[i, :, 2 * HIDDEN :])
                carry = slope * update[i] + at @ back
            slopes[:, :, : 2 * HIDDEN] = carried[:, :, : 2 * HIDDEN]
            out[f"state{d}"] += before.reshape(-1, HIDDEN).T @ carried.reshape(-1, 3 * HIDDEN)
            read = windows[:, list(order)].T.ravel()
            slopes = slopes.reshape(-1, 3 * HIDDEN)
            # The slopes of a byte's row are those of all places that read it.
            order = np.argsort(read, kind="stable")
            firsts = np.flatnonzero(np.diff(read[order], prepend=-1))
            out[f"in{d}"][read[order][firsts]] = np.add.reduceat(slopes[order], firsts, axis=0)
        return loss, out


def fit(texts: dict[str, list[bytes]], steps: int = STEPS) -> Network | None:
    """Network from the texts of each language."""
    texts = {language: [t for t in some if t] for language, some in texts.items()}
    languages = sorted(language for language, some in texts.items() if some)
    if not languages:
        return None
    network, rng = Network(languages), np.random.default_rng(2)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    for step in range(1, steps + 1):
        labels = rng.integers(len(languages), size=BATCH)
        windows = np.zeros((BATCH, WINDOW), np.uint8)
        for row, label in enumerate(labels):
            some = texts[languages[label]]
            text = some[rng.integers(len(some))]
            start = rng.integers(max(len(text) - WINDOW, 0) + 1)
            part = np.frombuffer(text[start : start + WINDOW], np.uint8)
            windows[row, : len(part)] = part
        _, slopes = network.gradients(windows, labels)
        rate = RATE * min(1.0, 2 - 2 * step / (steps + 1))
        for name, slope in slopes.items():
            first, second = moments[name]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            network.weights[name] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return network


def pooled(network: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean probabilities of each text's positions; zeros for empty texts."""
    sizes = np.diff(bounds)
    counts = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), counts)
    inner = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * WINDOW
    starts, lengths = bounds[:-1][doc] + inner, np.minimum(sizes[doc] - inner, WINDOW)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    total = np.zeros((len(sizes), len(network.languages)))
    for at in range(0, len(doc), TOGETHER):
        part = slice(at, at + TOGETHER)
        valid = np.arange(WINDOW) < lengths[part, None]
        windows = np.where(valid, padded[starts[part, None] + np.arange(WINDOW)], 0).astype(np.uint8)
        found = network.probabilities(windows)
        for language, values in enumerate(found):
            total[:, language] += np.bincount(doc[part], np.einsum("tw,wt->w", values, valid.astype(np.float32)), len(sizes))
    return total / np.maximum(sizes, 1)[:, None]


def held_out(doc_id: Column) -> Column:
    """Rows that fitting never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> Network | None:
    """Network fitted on a bounded sample of the rows of ``docs`` with a language."""
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.where(F.octet_length("text").between(1, TRAIN_BYTES))
    # At most ``TRAIN_DOCS`` ids, so the side is small whatever the tables.
    chosen = known.select("doc_id", F.xxhash64("doc_id").alias("at")).orderBy("at", "doc_id").limit(TRAIN_DOCS).distinct()
    rows = known.join(F.broadcast(chosen), "doc_id").select("at", "doc_id", "lang", "text").orderBy("at", "doc_id", "lang", "text").limit(TRAIN_DOCS).collect()
    texts = defaultdict(list)
    for row in rows:
        texts[row.lang].append(row.text.encode())
    return fit(texts)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for rows in slices(batches, "text"):
            letters = pc.fill_null(pc.match_substring_regex(rows.column("text"), r"\pL"), False).to_numpy(zero_copy_only=False)
            if network is None:
                languages, best, scores = ["und"], np.zeros(len(rows), np.int64), np.zeros(len(rows))
            else:
                means = pooled(network, *flat(rows.column("text")))
                languages = [*network.languages, "und"]
                best = np.where(letters, means.argmax(axis=1), len(network.languages))
                scores = np.where(letters, np.clip(means.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(languages).take(pa.array(best)), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, lang_pred string, score double")


def predictions(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
