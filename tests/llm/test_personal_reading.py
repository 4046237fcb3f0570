"""The tagger reads texts with the same gates that it was trained with."""

from __future__ import annotations

import numpy as np

from larder.llm.personal import LABELS, Tagger


def test_reading_gives_the_emissions_of_training():
    tagger = Tagger(seed=3)
    for name in ("Ef", "Eb", "Uf", "Ub"):  # gates as wide open as those of a trained one
        tagger.w[name] *= 5
    x = np.random.default_rng(4).integers(0, 129, (200, 7)).astype(np.int64)
    back = tagger._forward(x[::-1], "b")[0][::-1]
    want = tagger._forward(x, "f")[0] @ tagger.w["Of"] + back @ tagger.w["Ob"]
    em = np.zeros((200, LABELS, 7), np.float32)
    tagger._read(x, "f", em, range(200))
    tagger._read(x, "b", em, range(199, -1, -1))
    assert np.abs(em.transpose(0, 2, 1) - want).max() < 1e-4
