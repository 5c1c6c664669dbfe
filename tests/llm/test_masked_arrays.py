"""Words are split, looked up and hashed by arrays, as one at a time would be."""

import numpy as np
import pyarrow as pa
from llm import cases

from fleetmetrics.llm import masked_lm


def test_arrays_equal_single_words(monkeypatch):
    """Every byte between letters, nulls, slices; a hash for each end of rare words, not for each word."""
    texts = [t and t.encode() for _, t in cases.awkward_texts()] + [bytes([i]).join([b"Ax", b"The", b"", b"xThe"]) for i in range(256)]
    frequent = [b"the", b"an", b"or"]
    split = [(t or b"").translate(masked_lm.LOWER).split() for t in texts]
    known = {w: i + 1 for i, w in enumerate(frequent)}
    tokens = [known.get(w) or 1 + masked_lm.WORDS + masked_lm.zlib.crc32(w[-3:]) % masked_lm.RARE for t in split[3:] for w in t]
    calls, crc32 = [], masked_lm.zlib.crc32
    monkeypatch.setattr(masked_lm.zlib, "crc32", lambda end: calls.append(end) or crc32(end))
    found, around, sizes = masked_lm.windows(masked_lm.Vocabulary(frequent), pa.array(texts, pa.binary()).slice(3))
    assert found.tolist() == tokens
    assert sizes.tolist() == [len(t) for t in split[3:]]
    ends = np.cumsum(sizes)
    for row, end in enumerate(ends):
        padded = [0, 0, *tokens[end - sizes[row] : end], 0, 0]
        for at in range(sizes[row]):
            assert around[:, end - sizes[row] + at].tolist() == [padded[at + 2 + o] for o in masked_lm.OFFSETS]
    assert len(calls) == len({w[-3:] for t in split[3:] for w in t if w not in known})
