"""BPE encoding by speculation, and decoding.

The greedy longest match proposes the tokens of a word. They are what the merges give exactly if every token is
what its own characters merge to and no merge across any border between neighbours would have come first. The
latter depends on the two tokens alone, so all pairs of a batch are tested together: walking back through the
merges that made the left token's last part and the right token's first part, no pair of parts that stood next
to each other may have a merge that was due before one of them was merged away. Words with a failing pair
are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks
from larder.llm.ragged import PieceIds, flattened, take_runs

#: White space as the tokenizer's own pattern has it, and what of it is neither a space nor a line end.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
RARE_SPACES = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: A full stop or comma that does not follow a letter or digit of a fixed, old range.
LOOSE_MARK = re.compile(r"[.,](?=[ \n])(?<![0-9A-Za-zÀ-ÖØ-öø-ɏ][.,])")
#: Distinct chunks that a worker remembers, about 250 bytes each.
CHUNKS = 600_000
NEVER = np.iinfo(np.int64).max


class WordEncoder:
    """Merges of one tokenizers file with an end-of-word suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        size = 1 + max([*self.vocabulary.values(), *self.specials.values()])
        self._merges([m if isinstance(m, list) else m.split(" ") for m in model["merges"]], size)
        # printable stand-ins of the 256 bytes
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.letters = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.tables = str.maketrans({chr(b): c for b, c in self.letters.items()})
        self._proposals()

    def _merges(self, merges: list, size: int) -> None:
        left = np.array([self.vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([self.vocabulary[b] for _, b in merges], np.int64)
        made = np.array([self.vocabulary[a + b[: len(b)]] for a, b in merges], np.int64)
        self.size = size
        codes = left * size + right
        order = np.argsort(codes, kind="stable")
        self.codes, self.code_ranks = codes[order], order.astype(np.int64)
        self.rank_of = dict(zip(zip(left.tolist(), right.tolist(), strict=True), range(len(merges)), strict=True))
        self.made = made.tolist()
        # how a token was made: the rank of its merge (-1: a single character) and the two parts
        self.rank = np.full(size, -1, np.int64)
        self.first, self.second = np.arange(size), np.arange(size)
        self.rank[made[::-1]] = np.arange(len(merges))[::-1]
        self.first[made[::-1]], self.second[made[::-1]] = left[::-1], right[::-1]
        has = self.rank >= 0
        tokens = np.flatnonzero(has)
        whole = np.ones(size, bool)
        own = self._compatible(self.first[tokens], self.second[tokens], self.rank[tokens])
        whole[tokens] = own
        for token in tokens[np.argsort(self.rank[tokens])]:  # parts come before what is made of them
            whole[token] &= whole[self.first[token]] and whole[self.second[token]]
        self.whole = whole

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, self.code_ranks[at], NEVER)

    def _compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbours whether no merge crosses their border (before rank ``until``)."""
        ok = np.ones(len(a), bool)
        left_end = np.full(len(a), NEVER) if until is None else until.copy()
        right_end = left_end.copy()
        at, x, y = np.arange(len(a)), a.copy(), b.copy()
        top = until is not None  # the pair itself merges at ``until``, which is no fault
        while len(at):
            due = self._merge_rank(x, y)
            # of equal pairs the leftmost merges first: a tie with the left part's own merge is no fault
            fault = (due < left_end) & ((due < right_end) if top else (due <= right_end)) & (due < NEVER)
            top = False
            ok[at[fault]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~fault & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry = at[go], x[go], y[go], rx[go], ry[go]
            left_end, right_end = left_end[go], right_end[go]
            back = rx > ry  # the part that was made last is taken apart first
            left_end, right_end = np.where(back, rx, left_end), np.where(back, right_end, ry)
            x, y = np.where(back, self.second[x], x), np.where(back, y, self.first[y])
        return ok

    def _proposals(self) -> None:
        """Tokens by their characters, those at a word's end apart."""
        self.inner, self.last = {}, {}
        for name, i in self.vocabulary.items():
            if self.whole[i]:
                if self.suffix and name.endswith(self.suffix) and len(name) > len(self.suffix):
                    self.last[name[: -len(self.suffix)]] = i
                else:
                    self.inner[name] = i
        self.longest = max(map(len, [*self.inner, *self.last]))

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; ``word`` in the stand-ins of its bytes."""
        out, at, n = [], 0, len(word)
        inner, last, longest = self.inner.get, self.last.get, self.longest
        while at < n:
            if n - at <= longest and (token := last(word[at:])) is not None:
                out.append(token)
                break
            end = min(n - 1, at + longest)
            while (token := inner(word[at:end])) is None:
                end -= 1
            out.append(token)
            at = end
        return out

    def merge_long(self, parts: list[int]) -> list[int]:
        """``merge`` with a heap of due merges, for words of many characters."""
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        due = [(r, i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := self.rank_of.get(p)) is not None]
        heapq.heapify(due)
        while due:
            rank, i = heapq.heappop(due)
            j = after[i] if parts[i] >= 0 else -1
            if j < 0 or self.rank_of.get((parts[i], parts[j])) != rank:
                continue  # one of the two was merged away meanwhile
            parts[i], parts[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := self.rank_of.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(due, (r, a))
        return [p for p in parts if p >= 0]

    def merge(self, word: str) -> list[int]:
        """The merges themselves, in their order, leftmost first."""
        parts = [self.vocabulary[c] for c in word[:-1]] + [self.vocabulary[word[-1] + self.suffix]]
        if len(parts) > 48:
            return self.merge_long(parts)
        while len(parts) > 1:
            ranks = [self.rank_of.get(p, NEVER) for p in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == NEVER:
                break
            merged, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    merged.append(self.made[best])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def encode_words(self, words: list[str]) -> list[list[int]]:
        proposals = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(words)), sizes)
        inside = np.flatnonzero(word[1:] == word[:-1])
        codes, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        fine = self._compatible(codes // self.size, codes % self.size)[back]
        for i in np.unique(word[inside[~fine]]).tolist():
            proposals[i] = self.merge(words[i])
        return proposals

    def words_of(self, chunk: str) -> list[str]:
        """Words of a chunk without white space, in the stand-ins of their bytes."""
        if chunk.isascii():
            words = ASCII_WORDS.findall(chunk.lower())
            return words if chunk.isprintable() else [w.translate(self.tables) for w in words]
        if unicodedata.is_normalized("NFC", chunk) and max(chunk) < "ɐ":
            chunk = chunk.lower()
        else:
            chunk = self.library.normalizer.normalize_str(chunk)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def encode_chunks(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The chunks, their ids one after the other and the number of each; a word is encoded once."""
        split, words = [], {}
        for chunk in chunks:
            parts = []
            marked = self.special_pattern is not None and "<" in chunk
            for piece in self.special_pattern.split(chunk) if marked else [chunk]:
                if piece in self.specials:
                    parts.append(-1 - self.specials[piece])
                elif piece:
                    parts.extend(words.setdefault(w, len(words)) for w in self.words_of(piece))
            split.append(parts)
        ids = self.encode_words(list(words))
        lists = [
            ids[parts[0]] if len(parts) == 1 and parts[0] >= 0 else [t for p in parts for t in (ids[p] if p >= 0 else [-1 - p])]
            for parts in split
        ]
        return chunks, *flattened(lists)


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@cache
def _pieces(path: str) -> PieceIds:
    one = encoder(path)
    return PieceIds(one.encode_chunks, CHUNKS)


@cache
def _names(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token names, each with a space behind, as one array of bytes; starts and sizes.

    Read from the file alone: a worker that only decodes holds no merges.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    known = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    names = [b" "] * (1 + max(known.values()))
    for name, i in known.items():
        names[i] = (name + " ").encode()
    sizes = np.fromiter(map(len, names), np.int64, len(names))
    return np.frombuffer(b"".join(names), np.uint8), np.cumsum(sizes) - sizes, sizes


def chunks_of(texts: list[str | None]) -> pa.ListArray:
    """Texts cut at white space, and before the full stop or comma that ends a word; some chunks are empty."""
    plain = [SPACES.sub(" ", t) if t and RARE_SPACES.search(t) else t or "" for t in texts]
    loose = [LOOSE_MARK.search(t) is not None for t in plain]
    whole = pa.array(plain, pa.large_string())
    ends = pc.replace_substring(pc.replace_substring(whole, ". ", " . "), ", ", " , ")
    ends = pc.replace_substring(ends, ".\n", " .\n")
    marked = pc.if_else(pa.array(loose), whole, ends) if any(loose) else ends
    return pc.split_pattern(pc.replace_substring(marked, "\n", " "), " ")


def encode_texts(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Ids of every whole text; a null text is empty."""
    return _pieces(path).ids(chunks_of(texts))


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    """UTF-8 of the token names with single spaces between, as this kind of tokenizer decodes."""
    flat, starts, sizes = _names(path)
    return take_runs(flat, starts[ids], sizes[ids]).tobytes()[:-1]


def _encode_pass(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_blocks(batches, "text", 1_000_000):
            ids = [x.astype("<u4") for x in encode_texts(batch["text"].to_pylist(), path)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([x.tobytes() for x in ids], pa.binary())], ["doc_id", "ids"]
            )

    return run


def _decode_pass(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_blocks(batches, "ids", 1_000_000):
            texts = [decode_ids(np.frombuffer(x or b"", "<u4"), path) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, "decoded"]
            )

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of ``docs(doc_id, text)``; ``ids`` are little-endian unsigned 32-bit integers.

    Every whole text is encoded, without a shuffle. Null, empty and blank texts have no ids; repeated rows
    and null doc_ids stay; an empty table gives an empty result. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), _encode_pass(path), f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded(doc_id, ids)`` with the decoded text; null ids decode to the empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return arrow_map(encoded.select("doc_id", "ids"), _decode_pass(path), f"doc_id {kind}, ids binary, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    ids = F.coalesce("ids", F.lit(b""))
    return decoded.select(
        "doc_id",
        (F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
