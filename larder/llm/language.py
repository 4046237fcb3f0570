"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a window of bytes from either end, and every position gets a probability for
each language; a document's probabilities are the mean over all its positions. The network is trained here by
backpropagation through time on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks
from larder.llm.nets import Adam, add_rows, glorot, softmax

UNKNOWN = "und"
#: Bounds of the training sample: documents of each language and of all together (every language keeps one at
#: least), and characters of each.
PER_LANGUAGE = 400
SAMPLE_DOCS = 25_600
SAMPLE_CHARS = 1500
HIDDEN = 16
TRAIN_WINDOW, WINDOW = 48, 128
STEPS, STEPS_PER_LANGUAGE, BATCH = 220, 12, 128


class GatedNetwork:
    """h' = n + z (h - n), n = tanh(a_n + r u_n); gates z, r from the byte's row a and u = h U."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.w: dict[str, np.ndarray] = {"bias": np.zeros(len(languages), np.float32)}
        for d in "fb":
            self.w[f"E{d}"] = (0.3 * rng.standard_normal((256, 3 * hidden))).astype(np.float32)
            self.w[f"U{d}"] = glorot(rng, hidden, 3 * hidden)
            self.w[f"O{d}"] = glorot(rng, hidden, len(languages))

    def _forward(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States of all positions of ``x`` (positions, windows), read in its order."""
        E, U, H = self.w[f"E{d}"], self.w[f"U{d}"], self.hidden
        h = np.zeros((x.shape[1], H), np.float32)
        states, kept = np.empty((*x.shape, H), np.float32), []
        for t, now in enumerate(x):
            a, u = E[now], h @ U
            gates = 0.5 + 0.5 * np.tanh(0.5 * (a[:, : 2 * H] + u[:, : 2 * H]))
            z, r = gates[:, :H], gates[:, H:]
            n = np.tanh(a[:, 2 * H :] + r * u[:, 2 * H :])
            kept.append((h, z, r, n, u[:, 2 * H :]))
            h = n + z * (h - n)
            states[t] = h
        return states, kept

    def _backward(self, x: np.ndarray, d: str, kept: list, grad_states: np.ndarray) -> dict:
        U, H = self.w[f"U{d}"], self.hidden
        gU, rows = np.zeros_like(U), np.empty((*x.shape, 3 * H), np.float32)
        g = np.zeros_like(grad_states[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, un = kept[t]
            g = g + grad_states[t]
            gn = g * (1 - z) * (1 - n * n)
            gz = g * (h - n) * z * (1 - z)
            gr = gn * un * r * (1 - r)
            rows[t, :, :H], rows[t, :, H : 2 * H], rows[t, :, 2 * H :] = gz, gr, gn
            gu = np.concatenate([gz, gr, gn * r], axis=1)
            gU += h.T @ gu
            g = g * z + gu @ U.T
        return {f"U{d}": gU, f"E{d}": add_rows(256, x.ravel(), rows.reshape(-1, 3 * H))}

    def train(self, texts: list[bytes], labels: np.ndarray, seed: int = 2) -> None:
        """Every position of a window is to have the label of its text."""
        rng = np.random.default_rng(seed)
        adam = Adam(self.w, 0.02)
        held = [np.frombuffer(t, np.uint8) for t in texts]
        of = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        steps = max(STEPS, STEPS_PER_LANGUAGE * len(self.languages))
        for step in range(steps):
            y = rng.integers(0, len(self.languages), BATCH)
            x = np.zeros((TRAIN_WINDOW, BATCH), np.int64)
            mask = np.zeros((TRAIN_WINDOW, BATCH, 1), np.float32)
            for i, k in enumerate(y):
                text = held[of[k][rng.integers(len(of[k]))]]
                start = rng.integers(max(1, len(text) - TRAIN_WINDOW + 1))
                part = text[start : start + TRAIN_WINDOW]
                x[: len(part), i], mask[: len(part), i] = part, 1
            forward, kf = self._forward(x, "f")
            backward, kb = self._forward(x[::-1], "b")
            p = softmax(forward @ self.w["Of"] + backward[::-1] @ self.w["Ob"] + self.w["bias"])
            p[:, np.arange(BATCH), y] -= 1
            p *= mask / mask.sum()
            flat = p.reshape(-1, p.shape[-1])
            grads = {
                "bias": flat.sum(axis=0),
                "Of": forward.reshape(-1, self.hidden).T @ flat,
                "Ob": backward[::-1].reshape(-1, self.hidden).T @ flat,
                **self._backward(x, "f", kf, p @ self.w["Of"].T),
                **self._backward(x[::-1], "b", kb, (p @ self.w["Ob"].T)[::-1]),
            }
            adam.update(grads, scale=1.0 if step < steps * 0.7 else 0.25)

    def _read(self, x: np.ndarray, d: str, logits: np.ndarray, order) -> None:
        """Add one direction's share of the logits (positions, languages, windows).

        Halved gate weights save the scaling of each step; windows lie side by side in memory, so every
        operation runs over whole rows.
        """
        H = self.hidden
        half = np.concatenate([np.full(2 * H, 0.5, np.float32), np.ones(H, np.float32)])
        E, U, out = (np.ascontiguousarray(m.T) for m in (self.w[f"E{d}"] * half, self.w[f"U{d}"] * half, self.w[f"O{d}"]))
        size = x.shape[1]
        h, n, part = np.zeros((H, size), np.float32), np.empty((H, size), np.float32), np.empty((len(out), size), np.float32)
        a, u = np.empty((3 * H, size), np.float32), np.empty((3 * H, size), np.float32)
        gates, z, r, an, un = a[: 2 * H], a[:H], a[H : 2 * H], a[2 * H :], u[2 * H :]
        for t in order:
            np.take(E, x[t], axis=1, out=a, mode="clip")
            np.matmul(U, h, out=u)
            gates += u[: 2 * H]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            np.multiply(r, un, out=n)
            n += an
            np.tanh(n, out=n)
            h -= n
            h *= z
            h += n
            np.matmul(out, h, out=part)
            logits[t] += part

    def window_sums(self, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums of the probabilities of all positions of each window (rows of bytes)."""
        sums = np.empty((len(windows), len(self.languages)), np.float64)
        for start in range(0, len(windows), 1024):
            x = np.ascontiguousarray(windows[start : start + 1024].T).astype(np.intp)
            logits = np.empty((len(x), len(self.languages), x.shape[1]), np.float32)
            logits[:] = self.w["bias"][:, None]
            self._read(x, "f", logits, range(len(x)))
            self._read(x, "b", logits, range(len(x) - 1, -1, -1))
            logits -= logits.max(axis=1, keepdims=True)
            np.exp(logits, out=logits)
            logits /= logits.sum(axis=1, keepdims=True)
            short = np.flatnonzero(sizes[start : start + 1024] < len(x))
            for i in short:
                logits[sizes[start + i] :, :, i] = 0
            sums[start : start + 1024] = logits.sum(axis=0).T
        return sums

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and pooled probability of each text."""
        raw = [t.encode("utf-8", "surrogatepass") if t and any(map(str.isalpha, t)) else b"" for t in texts]
        counts = np.array([-(-len(r) // WINDOW) for r in raw], np.int64)
        firsts = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
        sizes = np.full(int(counts.sum()), WINDOW, np.int64)
        for r, c, f in zip(raw, counts, firsts, strict=True):
            flat[f * WINDOW : f * WINDOW + len(r)] = np.frombuffer(r, np.uint8)
            if c:
                sizes[f + c - 1] = len(r) - (c - 1) * WINDOW
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = np.flatnonzero(counts)
        if len(some):
            sums = np.add.reduceat(self.window_sums(flat.reshape(-1, WINDOW), sizes), firsts[some], axis=0)
            pooled = sums / sums.sum(axis=1, keepdims=True)
            best = pooled.argmax(axis=1)
            for i, k, p in zip(some, best, pooled.max(axis=1), strict=True):
                names[i], scores[i] = self.languages[k], min(1.0, float(p))
        return names, scores


def is_held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def learn_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> GatedNetwork | None:
    """A network trained on documents that are not held out; None without any labelled text.

    The sample is bounded: about ``per_language`` documents of each language, fewer where there are so many
    languages that ``SAMPLE_DOCS`` would be exceeded, chosen by a hash of doc_id and text, and ``SAMPLE_CHARS``
    characters of each from a place that the hash gives. Rows that repeat a doc_id and text count as one.
    """
    rows = docs.select("doc_id", "text", "lang").where(
        ~F.coalesce(is_held_out(), F.lit(False)) & F.col("lang").isNotNull()
    )
    which = F.xxhash64("doc_id", "text")
    counts = rows.groupBy("lang").agg(F.count("*").alias("count"), F.min(which).alias("least")).collect()  # one row per language
    if not counts:
        return None
    per_language = max(1, min(per_language, SAMPLE_DOCS // len(counts)))
    shares = [x for r in counts for x in (r["lang"], min(1_000_000, -(-1_250_000 * per_language // r["count"])))]
    least = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], r["least"])))
    mark = F.pmod(F.xxhash64(which, F.lit("sample")), F.lit(1_000_000))
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS))
    chosen = (mark < F.try_element_at(F.create_map(*map(F.lit, shares)), F.col("lang"))) | (which == F.try_element_at(least, F.col("lang")))
    drawn = rows.where(chosen).select(
        "lang", which.alias("order"), F.substring("text", (place + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text")
    )
    sample = drawn.groupBy("lang", "order").agg(F.min("text").alias("text"))
    taken: dict[str, list[bytes]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r.lang, r.order, r.text or "")):
        if row.text and any(map(str.isalpha, row.text)) and len(taken.setdefault(row.lang, [])) < per_language:
            taken[row.lang].append(row.text.encode("utf-8", "surrogatepass"))
    languages = sorted(k for k, v in taken.items() if v)
    if not languages:
        return None
    network = GatedNetwork(languages)
    texts = [t for k in languages for t in taken[k]]
    network.train(texts, np.repeat(np.arange(len(languages)), [len(taken[k]) for k in languages]))
    return network


def _predict_pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in by_blocks(batches, "text"):
            texts = batch["text"].to_pylist()
            names, scores = network.predict(texts) if network else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, network: GatedNetwork | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text, without a shuffle.

    Texts that are null or have no letter are ``und`` with score 0, as is every text if nothing was learned.
    Repeated rows and null doc_ids stay; an empty table gives an empty result. Only doc_id and text are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return arrow_map(docs.select("doc_id", "text"), _predict_pass(shared), f"doc_id {kind}, lang_pred string, score double")
