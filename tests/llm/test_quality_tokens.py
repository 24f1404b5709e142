"""Every byte of a long token counts in the quality features."""

import numpy as np

from roomtide.llm import quality


def test_long_tokens():
    rng = np.random.default_rng(5)
    score = quality.Ordinal(rng.standard_normal(1 << quality.BITS), np.array([-1.0, 1.0])).scorer()
    text = "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 5000, 400)).encode()
    tokens = quality.tokens_of(b"a " + text)
    assert b"".join(tokens) == b"a" + text and max(map(len, tokens)) <= quality.PIECE
    changed = text[:900] + bytes([text[900] ^ 1]) + text[901:]
    known, other = ({quality.token_indices(t) for t in quality.tokens_of(x)} for x in (text, changed))
    assert len(known & other) == len(known) - 1 > 20
    assert score(text) != score(changed)
    # a mark far behind shows in the shape
    assert quality.shape(b"a.b-c_d:e/f=g?h") != quality.shape(b"a.b-c_d:e/f=g?H")
    assert quality.tokens_of(None) == [] and quality.tokens_of(b"plain words") == [b"plain", b"words"]
