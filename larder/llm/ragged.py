"""Lists of token ids kept as one flat array, and a bounded cache of the ids of text pieces."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, islice, pairwise, repeat

import numpy as np
import pyarrow as pa


def take_runs(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + size]`` one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after the other, and the size of each list."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


class PieceIds:
    """Ids of distinct pieces, computed once each while at most ``most`` pieces are held.

    ``encode`` takes pieces and gives them back, in any order, with their ids one after the other and the
    number of ids of each. The cache only saves work: when it is full its later half is forgotten (the first
    seen pieces are the frequent ones), and a piece is encoded again when it next occurs. Pieces that
    ``fits`` refuses are never encoded.
    """

    def __init__(self, encode: Callable, most: int = 600_000, fits: Callable | None = None):
        self.encode, self.most, self.fits = encode, most, fits
        self.index: dict = {}
        self.starts = np.zeros(1024, np.int64)
        self.sizes = np.zeros(1024, np.int32)
        self.flat = np.zeros(4096, np.int32)
        self.used = 0

    def _forget(self) -> None:
        self.index = dict(islice(self.index.items(), self.most // 2))
        n = len(self.index)
        self.used = int(self.starts[n - 1] + self.sizes[n - 1]) if n else 0

    def _learn(self, missing: list) -> None:
        pieces, ids, sizes = self.encode(missing)
        n = len(self.index)
        if n + len(pieces) > len(self.starts):
            room = max(2 * len(self.starts), n + len(pieces)) - len(self.starts)
            self.starts = np.append(self.starts, np.zeros(room, np.int64))
            self.sizes = np.append(self.sizes, np.zeros(room, np.int32))
        if self.used + len(ids) > len(self.flat):
            room = max(2 * len(self.flat), self.used + len(ids)) - len(self.flat)
            self.flat = np.append(self.flat, np.zeros(room, np.int32))
        self.starts[n : n + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n : n + len(pieces)] = sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def places(self, pieces: list) -> np.ndarray:
        """Where the ids of each of the distinct ``pieces`` are; -1 for refused ones."""
        at = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(at < 0).tolist()
        if self.fits is not None:
            unknown = [i for i in unknown if self.fits(pieces[i])]
        if unknown:
            if len(self.index) + len(unknown) > self.most and len(self.index) > self.most // 2:
                self._forget()
                return self.places(pieces)
            self._learn([pieces[i] for i in unknown])
            at[unknown] = np.fromiter((self.index[pieces[i]] for i in unknown), np.int64, len(unknown))
        return at

    def ids(self, texts: pa.ListArray) -> list[np.ndarray | None]:
        """For each list of pieces the ids of its pieces one after the other; None if one is refused."""
        ends = texts.offsets.to_numpy().astype(np.int64)
        coded = texts.flatten().dictionary_encode()
        at = self.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        refused = set(np.searchsorted(ends - ends[0], np.flatnonzero(at < 0), side="right") - 1)
        sizes = np.where(at < 0, 0, self.sizes[at])
        ids = take_runs(self.flat, self.starts[at], sizes)
        bounds = np.append(0, np.cumsum(sizes, dtype=np.int64))[ends - ends[0]]
        return [None if i in refused else ids[a:b] for i, (a, b) in enumerate(pairwise(bounds.tolist()))]
