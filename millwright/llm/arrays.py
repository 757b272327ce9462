"""Words and hashes of many texts at once, as numpy arrays.

Texts are laid end to end with a line feed between them, so a batch costs a
handful of array operations instead of a Python step per word.
"""

from collections.abc import Callable, Iterator

import numpy as np

#: bytes worked on at a time; a longer text comes alone
PART_BYTES = 1 << 19
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15


def parts(texts: list[bytes], limit: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The texts in runs of at most ``limit`` bytes."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text) > limit:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text) + 1
    if run:
        yield run


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text followed by a line feed, and where each text begins."""
    sizes = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), np.cumsum(sizes) - sizes


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space."""
    inside = ~_WHITE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    if len(inside) and inside[-1]:
        edge = np.concatenate([edge, [len(inside)]])
    return edge[::2], edge[1::2]


def mixed(value: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; one to one."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


#: a value for each byte
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
#: bytes that the second sum takes together
_RUN = 8

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 to the 64th."""
    held = _powers.get(0)
    if held is None or len(held[0]) < size:
        size = max(size, PART_BYTES)
        factors = np.full((2, size), _BASE, np.uint64)
        factors[1] = pow(_BASE, -1, 1 << 64)
        factors[:, 0] = 1
        held = tuple(np.multiply.accumulate(factors, axis=1))
        _powers[0] = held
    return held[0][:size], held[1][:size]


def _sums(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return sums


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from starts and ends to 64-bit hashes of the spans' bytes, the same wherever they stand.

    Polynomials modulo a power of two agree on some pairs of regular strings
    whatever their base. So a second one, over scrambled runs of eight bytes,
    is mixed in: it has no two letters that could be exchanged. The sums over
    the data are built once, whatever the number of calls.
    """
    powers, inverses = _power_table(len(data) + 1)
    letters = _sums(_LETTERS[data], powers)
    held: list[np.ndarray] = []

    def scrambled() -> np.ndarray:
        if not held:
            runs = np.lib.stride_tricks.sliding_window_view(data, _RUN).copy().view(np.uint64).ravel()
            held.append(_sums(mixed(runs + np.uint64(_BASE)), powers))
        return held[0]

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = mixed((letters[ends] - letters[starts]) * inverses[starts])
        if len(data) < _RUN or not len(starts):
            return found
        wide = ends - starts >= _RUN
        long = slice(None) if wide.all() else np.flatnonzero(wide)
        if wide.any():
            runs = scrambled()
            first, last = starts[long], ends[long] - _RUN + 1
            found[long] = mixed(found[long] ^ mixed((runs[last] - runs[first]) * inverses[first] + np.uint64(1)))
        return found

    return hashes


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of one set of spans, see ``span_hasher``."""
    return span_hasher(data)(starts, ends)
