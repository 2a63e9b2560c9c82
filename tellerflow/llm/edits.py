"""Exact edit distances of word sequences by bit-parallel dynamic programming."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable


def masks_of(pattern: Iterable[int]) -> dict[int, int]:
    """For each word of the pattern, the bits of its places."""
    masks: dict[int, int] = defaultdict(int)
    for i, word in enumerate(pattern):
        masks[word] |= 1 << i
    return masks


def distance(masks: dict[int, int], n: int, text: Iterable[int], anywhere: bool = False) -> tuple[int, int]:
    """Least edits between a pattern of n words and the text, and the text's length then.

    With ``anywhere`` the pattern is compared with every passage of the text, and
    the second number is where the first nearest one ends. One column of the
    distance matrix is a pair of integers, whatever the pattern's length.
    """
    if not n:
        return (0, 0) if anywhere else (sum(1 for _ in text), 0)
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best, end, j = full, 0, n, n, 0, 0
    for j, word in enumerate(text, 1):
        eq = masks.get(word, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(zero | plus) & full, plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & full | (not anywhere), down << 1 & full
        plus, minus = down | ~(zero | up) & full, up & zero
        if score < best:
            best, end = score, j
    return (best, end) if anywhere else (score, j)
