"""Words of many texts as 64-bit numbers, computed over whole batches of bytes.

A word is a run of bytes of one kind: letters, digits and all non-ASCII bytes are one kind, other signs another, and
blanks and control characters stand between words. Long texts are taken in pieces that end at a blank, so what is held
beside the numbers does not grow with a text.
"""

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# Kind of each byte: 0 blank, 1 word, 2 other sign.
KIND = np.full(256, 2, dtype=np.int8)
KIND[:33] = 0
KIND[127] = 0
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    KIND[_low:_high] = 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _MULTIPLIER, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def segments(data: np.ndarray, kinds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    kinds = KIND[data] if kinds is None else kinds
    edge = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]]) if len(data) else np.empty(0, dtype=np.int64)
    ends = np.r_[edge[1:], len(data)] if len(data) else edge
    word = kinds[edge] != 0
    return edge[word], ends[word]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for the bytes of each segment; equal bytes have equal numbers."""
    sizes = ends - starts
    if not len(sizes):
        return np.empty(0, dtype=np.uint64)
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    body = data[np.repeat(starts, sizes) + within].astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(body * _powers_to(int(sizes.max()))[within], first))


def pieces(texts: list[str | None], size: int = PIECE) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts as bytes in groups of about ``size``, in order: the row each part belongs to, and the parts. A longer text has
    groups of its own, cut after a line end where there is one."""
    rows: list[int] = []
    parts: list[bytes] = []
    held = 0
    for row, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if rows and held + len(data) > size:
            yield rows, parts
            rows, parts, held = [], [], 0
        if len(data) > size:
            while len(data) > size:
                cut = data.rfind(b"\n", size // 2, size) + 1 or data.rfind(b" ", size // 2, size) + 1
                cut = cut or data.find(b" ", size) + 1 or len(data)
                yield [row], [data[:cut]]
                data = data[cut:]
            yield [row], [data]
            continue
        rows.append(row)
        parts.append(data)
        held += len(data)
    if rows:
        yield rows, parts


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The parts in one array with a blank after each, and where each starts."""
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    return data, np.r_[0, np.cumsum([len(p) + 1 for p in parts])]
