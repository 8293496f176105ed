"""Sequential models the set-based operators are compared with."""

from __future__ import annotations

import random


def stack_chain(deliveries):
    """Blocks on the chain after delivering ``(seq, height, hash)`` in order."""
    chain = []
    for _, height, hash in sorted(deliveries):
        while chain and chain[-1][0] >= height:
            chain.pop()
        chain.append((height, hash))
    return chain


def random_deliveries(rng: random.Random, n: int, fork_rate: float, max_depth: int = 8):
    """A feed that sometimes steps back a few heights."""
    out, height = [], 0
    for seq in range(n):
        if height and rng.random() < fork_rate:
            height = max(0, height - rng.randint(1, max_depth))
        out.append((seq, height, f"{height}-{seq}"))
        height += 1
    return out
