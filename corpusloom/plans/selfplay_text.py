"""Text checks of a running conversation, in plain Python for use inside a model's batch function."""

from __future__ import annotations


def overlap(a: str, b: str, n: int = 4) -> float:
    """``order.gram_overlap`` of two texts: how many distinct runs of ``n`` words they share, against the text that has fewer; 0 if one has none."""
    runs = [{" ".join(run) for run in zip(*(words[k:] for k in range(n)))} for words in (t.casefold().split() for t in (a, b))]
    fewer = min(map(len, runs))
    return len(set.intersection(*runs)) / fewer if fewer else 0.0
