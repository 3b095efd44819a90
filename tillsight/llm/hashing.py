"""64-bit hashes of the words of many texts at once.

Words are maximal runs of other bytes than the six ASCII white-space ones, with A-Z in
lower case. A word's hash is a polynomial in its bytes, taken from running sums over the
whole buffer, and then mixed; equal words have equal hashes on any machine.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20  # bytes that are hashed at once
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint64) + 1
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
BLANKS = b"\t\n\x0b\x0c\r "


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of each number over all 64; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    def __init__(self):
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def prepare(self, size: int) -> None:
        if size > len(self.powers):
            size = max(size, PIECE + 4096)
            steps = np.full(size, BASE, dtype=np.uint64)
            back = np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverse = np.multiply.accumulate(steps), np.multiply.accumulate(back)

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of each word of a buffer."""
        raw = np.frombuffer(data, dtype="u1")
        self.prepare(len(raw) + 1)
        inside = IS_WORD[raw]
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(LOWER[raw] * self.powers[: len(raw)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64)), starts

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """The word hashes of each text, in order."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[bytes] = []
        owners: list[int] = []
        size = 0

        def settle() -> None:
            if not waiting:
                return
            hashes, starts = self.words(b"\n".join(waiting))
            begins = np.cumsum([0] + [len(x) + 1 for x in waiting])
            cuts = np.searchsorted(starts, begins)
            for i, a, b in zip(owners, cuts, cuts[1:]):
                out[i].append(hashes[a:b])
            waiting.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for piece in pieces(text.encode()):
                waiting.append(piece)
                owners.append(i)
                size += len(piece)
                if size >= PIECE:
                    settle()
                    size = 0
        settle()
        none = np.zeros(0, dtype=np.uint64)
        return [x[0] if len(x) == 1 else np.concatenate([none, *x]) for x in out]


def pieces(data: bytes, limit: int = PIECE) -> list[bytes]:
    """The text cut at white space into pieces of about the limit; words stay whole."""
    out, start = [], 0
    while len(data) - start > limit:
        cut = max(data.rfind(BLANKS[k : k + 1], start, start + limit) for k in range(6))
        if cut <= start:  # one word longer than the limit
            after = [x for k in range(6) if (x := data.find(BLANKS[k : k + 1], start + limit)) >= 0]
            if not after:
                break
            cut = min(after)
        out.append(data[start:cut])
        start = cut
    return [*out, data[start:]]
