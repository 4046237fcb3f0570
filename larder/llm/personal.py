"""Personal data by base patterns and by a character-level bidirectional LSTM with CRF transitions.

The network is trained here on spans: those that the base patterns find in a bounded sample of texts, and other
spellings of the same kinds written over them (an address with "at" and "dot", a phone number without its
plus, ...), among numbers that are no personal data. A text is read in overlapping windows; each is decoded by
itself, every position takes its label from the window in which it lies farther from the edge, and the spans
of the whole text are reconciled: base spans stay, and a span of the network is added if it touches none of
them and holds what its kind needs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks
from larder.llm.nets import Adam, add_rows, glorot, softmax

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # label 0: none
#: Bounds of the training sample, in documents and in characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 4000, 4000
HIDDEN = 16
WINDOW, OVERLAP = 384, 48
#: Windows are filled up with spaces to a multiple of this, and read with others of their width.
WIDTH = 128
TRAIN_WINDOW, BATCH, STEPS = 72, 64, 420

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
LOCAL_END = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind in the order of ``KINDS``, then start."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_END:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            found.append(("email", start, done))
        at = text.find("@", max(done, at + 1))
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                found.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = NOT_DIGIT.sub("", m.group())
                if 16 <= len(digits) <= 19 and passes_luhn(digits):
                    found.append(("card", m.start(), m.end()))
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


#: What a span of the network must hold besides.
AT_SIGN = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|[\[({]at[\])}]| at ) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[({]dot[\])}]| dot ) ?[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"([0-9]{1,3})(?:\[\.\]|\(\.\)| ?\. ?|,)([0-9]{1,3})(?:\[\.\]|\(\.\)| ?\. ?|,)([0-9]{1,3})(?:\[\.\]|\(\.\)| ?\. ?|,)([0-9]{1,3})")
PHONE_LIKE = re.compile(r"(?:00 ?[1-9][0-9]{0,2}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}")
CARD_LIKE = re.compile(r"[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}")
SHAPES = {"email": AT_SIGN, "ip": FOUR_PARTS, "card": CARD_LIKE, "phone": PHONE_LIKE}


def whole_value(kind: str, text: str, start: int, end: int) -> tuple[int, int] | None:
    """The part of a proposed span that has the shape of its kind, if there is one.

    A few characters on either side are looked at too, as the network may miss the ends of a value; the
    value may not go on in a letter or digit.
    """
    low, high = max(0, start - 12), min(len(text), end + 12)
    for m in SHAPES[kind].finditer(text, low, high):
        a, b = m.span()
        if a >= end or b <= start or (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum()):
            continue
        if kind == "ip" and max(map(int, m.groups())) > 255:
            continue
        if kind == "card" and not passes_luhn(NOT_DIGIT.sub("", m.group())):
            continue
        return a, b
    return None


def codes(text: str) -> np.ndarray:
    """ASCII characters as they are, all others as 128."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128).astype(np.uint8)


class Tagger:
    """Two LSTM layers over characters, emissions for each label, transitions between labels."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.w: dict[str, np.ndarray] = {
            "bias": np.zeros(LABELS, np.float32),
            "T": np.zeros((LABELS, LABELS), np.float32),
            "first": np.zeros(LABELS, np.float32),
            "last": np.zeros(LABELS, np.float32),
        }
        for d in "fb":
            self.w[f"E{d}"] = (0.3 * rng.standard_normal((129, 4 * hidden))).astype(np.float32)
            self.w[f"E{d}"][:, hidden : 2 * hidden] += 1.0  # remember at first
            self.w[f"U{d}"] = glorot(rng, hidden, 4 * hidden)
            self.w[f"O{d}"] = glorot(rng, hidden, LABELS)

    # training ---------------------------------------------------------------------------------

    def _forward(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        E, U, H = self.w[f"E{d}"], self.w[f"U{d}"], self.hidden
        h = np.zeros((x.shape[1], H), np.float32)
        c = np.zeros_like(h)
        states, kept = np.empty((*x.shape, H), np.float32), []
        for t, now in enumerate(x):
            a = E[now] + h @ U
            gates = 0.5 + 0.5 * np.tanh(0.5 * a[:, : 3 * H])
            i, f, o, g = gates[:, :H], gates[:, H : 2 * H], gates[:, 2 * H :], np.tanh(a[:, 3 * H :])
            new = f * c + i * g
            tanh_c = np.tanh(new)
            kept.append((h, c, i, f, o, g, tanh_c))
            c, h = new, o * tanh_c
            states[t] = h
        return states, kept

    def _backward(self, x: np.ndarray, d: str, kept: list, grad_states: np.ndarray) -> dict:
        U, H = self.w[f"U{d}"], self.hidden
        gU, rows = np.zeros_like(U), np.empty((*x.shape, 4 * H), np.float32)
        gh, gc = np.zeros_like(grad_states[0]), np.zeros_like(grad_states[0])
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, tanh_c = kept[t]
            gh = gh + grad_states[t]
            gc = gc + gh * o * (1 - tanh_c * tanh_c)
            ga = rows[t]
            ga[:, :H] = gc * g * i * (1 - i)
            ga[:, H : 2 * H] = gc * c * f * (1 - f)
            ga[:, 2 * H : 3 * H] = gh * tanh_c * o * (1 - o)
            ga[:, 3 * H :] = gc * i * (1 - g * g)
            gU += h.T @ ga
            gc = gc * f
            gh = ga @ U.T
        return {f"U{d}": gU, f"E{d}": add_rows(129, x.ravel(), rows.reshape(-1, 4 * H))}

    def _crf_gradient(self, em: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, dict]:
        """Gradients of the negative log-likelihood of the label paths ``y`` (positions, windows)."""
        T, first, last = self.w["T"], self.w["first"], self.w["last"]

        def logsum(v):
            top = v.max(axis=1, keepdims=True)
            return (top + np.log(np.exp(v - top).sum(axis=1, keepdims=True)))[:, 0]

        n, size = y.shape
        alpha, beta = np.empty_like(em), np.empty_like(em)
        alpha[0], beta[-1] = first + em[0], last
        for t in range(1, n):
            alpha[t] = logsum(alpha[t - 1][:, :, None] + T) + em[t]
        for t in range(n - 2, -1, -1):
            beta[t] = logsum((T[None] + (em[t + 1] + beta[t + 1])[:, None, :]).transpose(0, 2, 1))
        total = logsum(alpha[-1] + last)[None, :, None]
        g = np.exp(alpha + beta - total)
        joint = np.exp(alpha[:-1, :, :, None] + T + (em[1:] + beta[1:])[:, :, None, :] - total[..., None])
        gT = joint.sum(axis=(0, 1))
        np.subtract.at(gT, (y[:-1].ravel(), y[1:].ravel()), 1)
        g -= np.eye(LABELS, dtype=np.float32)[y]
        return g / size, {"T": gT / size, "first": g[0].sum(axis=0) / size, "last": g[-1].sum(axis=0) / size}

    def train(self, make, seed: int = 2) -> None:
        """``make(rng)`` gives one window of codes and its labels."""
        rng = np.random.default_rng(seed)
        adam = Adam(self.w, 0.02)
        for step in range(STEPS):
            pairs = [make(rng) for _ in range(BATCH)]
            x = np.stack([p[0] for p in pairs], axis=1).astype(np.int64)
            y = np.stack([p[1] for p in pairs], axis=1).astype(np.int64)
            forward, kf = self._forward(x, "f")
            backward, kb = self._forward(x[::-1], "b")
            back = backward[::-1]
            em = forward @ self.w["Of"] + back @ self.w["Ob"] + self.w["bias"]
            g, grads = self._crf_gradient(em, y)
            flat = g.reshape(-1, LABELS)
            grads |= {
                "bias": flat.sum(axis=0),
                "Of": forward.reshape(-1, self.hidden).T @ flat,
                "Ob": back.reshape(-1, self.hidden).T @ flat,
                **self._backward(x, "f", kf, g @ self.w["Of"].T),
                **self._backward(x[::-1], "b", kb, (g @ self.w["Ob"].T)[::-1]),
            }
            adam.update(grads, scale=1.0 if step < STEPS * 0.7 else 0.25, most=5.0)

    # reading ----------------------------------------------------------------------------------

    def _read(self, x: np.ndarray, d: str, em: np.ndarray, order) -> None:
        """Add one direction's emissions to ``em`` (positions, labels, windows); windows lie side by side in memory."""
        H = self.hidden
        # A gate is half of 1 + tanh: the rows of the gates are halved before it, and the halves behind it are left
        # out of h, which is kept doubled, so U and O are halved once more. All exact, as powers of two are.
        half = np.concatenate([np.full(3 * H, 0.5, np.float32), np.ones(H, np.float32)])
        E = np.ascontiguousarray((self.w[f"E{d}"] * half).T)
        U = np.ascontiguousarray((self.w[f"U{d}"] * (half * np.float32(0.5))).T)
        out = np.ascontiguousarray((self.w[f"O{d}"] * np.float32(0.5)).T)
        size = x.shape[1]
        h, c, g = (np.zeros((H, size), np.float32) for _ in range(3))
        a, u = np.empty((4 * H, size), np.float32), np.empty((4 * H, size), np.float32)
        part = np.empty((LABELS, size), np.float32)
        gates, i, f, o, new = a[: 3 * H], a[:H], a[H : 2 * H], a[2 * H : 3 * H], a[3 * H :]
        for t in order:
            np.take(E, x[t], axis=1, out=a, mode="clip")
            np.matmul(U, h, out=u)
            a += u
            np.tanh(a, out=a)
            gates += 1
            c *= f
            np.multiply(i, new, out=g)
            c += g
            c *= 0.5
            np.tanh(c, out=h)
            h *= o
            np.matmul(out, h, out=part)
            em[t] += part

    def decode(self, windows: np.ndarray) -> np.ndarray:
        """Best label path of each window (rows of codes), as rows of labels."""
        labels = np.zeros(windows.shape, np.uint8)
        T, first, last = self.w["T"], self.w["first"], self.w["last"]
        # no path with another label can win where "none" leads by more than any transitions could give
        enter = max(float((T[0, 1:] - T[0, 0]).max()), float((first[1:] - first[0]).max()))
        leave = max(float((T[1:, 0] - T[0, 0]).max()), float((last[1:] - last[0]).max()))
        stay = float((T[1:, 1:] - T[0, 0]).max())
        lead = max(stay, 0.0) + max(enter + leave - stay, 0.0)
        for start in range(0, len(windows), 2048):
            x = np.ascontiguousarray(windows[start : start + 2048].T).astype(np.intp)
            em = np.empty((len(x), LABELS, x.shape[1]), np.float32)
            em[:] = self.w["bias"][:, None]
            self._read(x, "f", em, range(len(x)))
            self._read(x, "b", em, range(len(x) - 1, -1, -1))
            ahead = em[:, 0] - em[:, 1:].max(axis=1)
            open_ = np.flatnonzero(ahead.min(axis=0) <= lead)
            if len(open_):
                labels[start + open_] = self._viterbi(em[:, :, open_].transpose(0, 2, 1)).T
        return labels

    def _viterbi(self, em: np.ndarray) -> np.ndarray:
        T = self.w["T"]
        n, size = em.shape[:2]
        back = np.empty(em.shape, np.uint8)
        score = self.w["first"] + em[0]
        for t in range(1, n):
            through = score[:, :, None] + T
            back[t] = through.argmax(axis=1)
            score = through.max(axis=1) + em[t]
        path = np.empty((n, size), np.uint8)
        path[-1] = (score + self.w["last"]).argmax(axis=1)
        for t in range(n - 1, 0, -1):
            path[t - 1] = back[t, np.arange(size), path[t]]
        return path


# windows of whole texts -------------------------------------------------------------------------


def window_starts(n: int) -> range:
    step = WINDOW - OVERLAP
    return range(0, max(1, n - OVERLAP), step) if n else range(0)


def label_texts(tagger: Tagger, texts: list[str]) -> list[np.ndarray]:
    """A label for every character of every text, joined from overlapping windows."""
    step, half = WINDOW - OVERLAP, OVERLAP // 2
    parts = [code[k : k + WINDOW] for code in map(codes, texts) for k in window_starts(len(code))]
    widths = np.array([-(-len(p) // WIDTH) * WIDTH for p in parts], np.int64)
    labels: list = [None] * len(parts)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width).tolist()
        windows = np.full((len(rows), width), 32, np.uint8)
        for row, i in zip(windows, rows, strict=True):
            row[: len(parts[i])] = parts[i]
        for i, found in zip(rows, tagger.decode(windows), strict=True):
            labels[i] = found if found.any() else None
    out, row = [], 0
    for text in texts:
        n, count = len(text), len(window_starts(len(text)))
        whole = np.zeros(n, np.uint8)
        for k in range(count):
            if labels[row + k] is not None:
                low = k * step + (half if k else 0)
                high = n if k == count - 1 else min(n, k * step + WINDOW - half)
                whole[low:high] = labels[row + k][low - k * step : high - k * step]
        row += count
        out.append(whole)
    return out


def reconcile(text: str, base: list[tuple[str, int, int]], labels: np.ndarray) -> list[tuple[str, int, int, bool]]:
    """Base spans and the network's further spans, by kind, then start; True marks base ones."""
    spans = [(k, a, b, True) for k, a, b in base]
    if labels.any():
        edges = np.flatnonzero(np.diff(labels, prepend=0, append=0))
        held = sorted((a, b) for _, a, b in base)
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            if not labels[a]:
                continue
            value = whole_value(KINDS[labels[a] - 1], text, a, b)
            if value and not any(s < value[1] and value[0] < e for s, e in held):
                held.append(value)
                spans.append((KINDS[labels[a] - 1], *value, False))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


# training windows -------------------------------------------------------------------------------


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _luhn_number(rng) -> str:
    body = str(rng.integers(3, 7)) + _digits(rng, 14)
    return next(body + str(c) for c in range(10) if passes_luhn(body + str(c)))


def respelled(rng, kind: str, value: str) -> str:
    """Another value of the kind, in one of its spellings; base spellings are among them."""
    pick = rng.integers(0, 6)
    if kind == "email":
        name, _, host = value.partition("@")
        name = "".join(rng.permutation(list(name))) if name.isalnum() else name
        at, dot = [("@", "."), ("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", ".")][pick]
        return name + at + host.replace(".", dot)
    if kind == "ip":
        return ["." , ".", ".", "[.]", "(.)", " . "][pick].join(str(x) for x in rng.integers(0, 256, 4))
    if kind == "card":
        number = _luhn_number(rng)
        mark = ["", "", " ", "-", ".", "/"][pick]
        return mark.join(number[i : i + 4] for i in range(0, 16, 4))
    a, b, c, d = _digits(rng, 1), _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return [f"+{a} ({b}) {c}-{d}", value, f"({b}) {c}-{d}", f"{b}-{c}-{d}", f"{b}.{c}.{d}", f"00{int(a) or 1} {b} {c} {d}"][pick]


def harmless(rng) -> str:
    """Numbers and marks that are no personal data."""
    d = lambda n: _digits(rng, n)
    return [
        f"20{d(2)}-0{d(1)}-1{d(1)}", f"{d(2)}.{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", d(int(rng.integers(1, 13))), f"${d(3)}.{d(2)}",
        f"{d(2)}:{d(2)}", f"at {d(2)} dot", f"({d(4)})", f"{d(3)}-{d(2)}", f"v{d(1)}.{d(1)}", f"{d(3)},{d(3)}", f"token={d(5)}a{d(4)}",
    ][rng.integers(0, 12)]


def window_maker(texts: list[str]):
    """A function that draws windows of the sample; half of them around a span or something like one."""
    spans = [(t, *s) for t in texts for s in base_spans(t)]
    by_kind = [[s for s in spans if s[1] == k] for k in KINDS]
    by_kind = [k for k in by_kind if k]

    def make(rng) -> tuple[np.ndarray, np.ndarray]:
        labels = np.zeros(TRAIN_WINDOW, np.uint8)
        draw = rng.random()
        if by_kind and draw < 0.55:
            some = by_kind[rng.integers(len(by_kind))]
            text, kind, a, b = some[rng.integers(len(some))]
            value, label = respelled(rng, kind, text[a:b]), KINDS.index(kind) + 1
        else:
            text = texts[rng.integers(len(texts))]
            a = b = int(rng.integers(len(text) + 1))
            value, label = (f" {harmless(rng)} " if draw < 0.75 else ""), 0
        before = int(rng.integers(0, TRAIN_WINDOW - min(len(value), TRAIN_WINDOW - 1)))
        joined = text[max(0, a - before) : a] + value + text[b : b + TRAIN_WINDOW]
        at = min(a, before)
        for _, s, e in base_spans(joined):  # neighbours of the drawn span are spans as well
            labels[s:e] = KINDS.index(_) + 1
        if label:
            labels[at : at + len(value)] = label
        x = np.full(TRAIN_WINDOW, 32, np.uint8)
        code = codes(joined[:TRAIN_WINDOW])
        x[: len(code)] = code
        return x, labels

    return make


def learn_spans(docs: DataFrame, most: int = SAMPLE_DOCS) -> Tagger | None:
    """A tagger trained on about ``most`` texts, chosen by a hash of the doc_id; None without any text.

    Of each text at most ``SAMPLE_CHARS`` characters are taken, from a place that the hash gives.
    """
    rows = docs.select("doc_id", "text").where("text IS NOT NULL AND text <> ''")
    count = docs.select("doc_id").count()
    if not count:
        return None
    mark = F.pmod(F.xxhash64("doc_id", F.lit("spans")), F.lit(1_000_000))
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS))
    sample = rows.where(mark < min(1_000_000, -(-1_000_000 * most // count))).select(
        F.substring("text", (place + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text")
    )
    texts = sorted(r.text for r in sample.limit(2 * most).collect())
    if not texts:
        return None
    tagger = Tagger()
    tagger.train(window_maker(texts))
    return tagger


def _find_pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        for batch in by_blocks(batches, "text", 1_000_000):
            texts = [t or "" for t in batch["text"].to_pylist()]
            labels = label_texts(tagger, texts) if tagger else [np.zeros(len(t), np.uint8) for t in texts]
            spans = [
                [{"kind": k, "start": a, "end": b, "base": s} for k, a, b, s in reconcile(t, base_spans(t), y)]
                for t, y in zip(texts, labels, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, SPANS)], ["doc_id", "spans"])

    return run


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find_personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """(doc_id, spans) of every whole text; spans are (kind, start, end, base) in code points.

    No shuffle. Null and empty texts have no spans; without a tagger only base spans are found; repeated
    rows and null doc_ids stay; an empty table gives an empty result. Only doc_id and text are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    return arrow_map(docs.select("doc_id", "text"), _find_pass(shared), f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    )
