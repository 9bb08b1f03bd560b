"""What travels between the tasks of the alignment."""

from __future__ import annotations

import numpy as np
import public_tokenizers

from framesift.llm import align


def test_long_lists_of_a_part_are_packed():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as left, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as right:
        part = align._Part(align.Sides(left.read(), right.read()))
    rng = np.random.default_rng(2)
    texts = [" ".join(f"word{int(x)}" for x in rng.zipf(1.3, 500) % 1000) for _ in range(64)]
    part.add(list(range(64)), texts)
    row = part.row(0)
    assert sum(part.word_n) == 64 * 500
    assert row.column("words").nbytes < 2.5 * sum(part.word_n)
