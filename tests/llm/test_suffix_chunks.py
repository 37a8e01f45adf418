"""Long texts behind empty ones."""

import random
from collections import Counter

import numpy as np
import pytest

from quantloom.llm import suffix_dedup


def test_a_long_text_behind_empty_ones_is_cut(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 900)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 500)
    r = random.Random(4)
    data = [b"", b"", bytes(r.randrange(97, 100) for _ in range(3000)), b"", bytes(r.randrange(97, 100) for _ in range(120))]
    parts = list(suffix_dedup._parts(data, 100))
    assert max(len(p.data) for *_, p in parts) <= 900
    seen = Counter((i, s + j) for _, text, start, count in suffix_dedup.text_pieces(data, 100) for i, s, m in zip(text.tolist(), start.tolist(), count.tolist()) for j in range(m))
    assert seen == Counter((i, s) for i, t in enumerate(data) for s in range(len(t) - 99))


def test_parts_beyond_the_places_are_refused():
    with pytest.raises(ValueError, match="24 bits"):
        suffix_dedup.Pieces(np.zeros((1 << 24) + 1, np.uint8), np.array([(1 << 24) + 1]), 100)
