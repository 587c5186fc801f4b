"""Texts as arrays: word bounds and rolling hashes of many texts at once.

Hashes are polynomials over random 64-bit values modulo 2**64, taken as
differences of running sums, then mixed. Equal strings have equal hashes; two
different strings have the same one with a probability of about 2**-64, but for
strings with a pattern modulo 2**64 (Thue-Morse) it is far higher. Where equal
hashes must mean equal strings, :class:`Checks` gives a second number, a
polynomial modulo two primes, where no such pattern exists.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240229)
_LETTER = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the step and of its inverse; kept up to 4M."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (_STEP, _BACK):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            made.append(np.multiply.accumulate(factors))
        if size > 1 << 22:
            return made[0][:n], made[1][:n]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of stretches of a sequence of 64-bit numbers."""

    def __init__(self, values: np.ndarray):
        up, self.down = _steps(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def windows(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash per stretch [start, end)."""
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


CHECK_BLOCK = 1 << 16
# Strings that a pattern makes equal modulo 2**64 are longer by far.
PLAIN_BYTES = 32
PRIMES = (np.uint64(2**31 - 1), np.uint64(2**31 - 19))
_BASES = [int(b) for b in _RANDOM.integers(2**29, 2**31 - 19, 2, np.uint64)]
_CHECKED_LETTER = [_RANDOM.integers(1, int(p), 256, np.uint64) for p in PRIMES]
_checked_powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in PRIMES]


def _checked_steps(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse modulo its prime; kept up to 4M."""
    if len(_checked_powers[which][0]) < n:
        size, prime = max(n, 2 * CHECK_BLOCK), int(PRIMES[which])
        made = []
        for base in (_BASES[which], pow(_BASES[which], -1, prime)):
            powers = np.ones(1, np.uint64)
            while len(powers) < size:
                further = powers * np.uint64(pow(base, len(powers), prime)) % PRIMES[which]
                powers = np.concatenate([powers, further[: size - len(powers)]])
            made.append(powers)
        if size > 1 << 22:
            return made[0][:n], made[1][:n]
        _checked_powers[which] = made[0], made[1]
    return _checked_powers[which][0][:n], _checked_powers[which][1][:n]


class Checks:
    """Second hashes of stretches: polynomials modulo two primes of 31 bits."""

    def __init__(self, values: list[np.ndarray]):
        """``values`` of the sequence modulo each prime."""
        self.sums, self.down = [], []
        for which, (prime, own) in enumerate(zip(PRIMES, values, strict=True)):
            up, down = _checked_steps(which, len(own) + 1)
            sums = np.zeros(len(own) + 1, np.uint64)
            # Of terms below 2**31 2**33 can be added up.
            np.cumsum(own * up[:-1] % prime, out=sums[1:])
            self.sums.append(sums)
            self.down.append(down)

    def windows(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One number of 62 bits per stretch [start, end)."""
        one, two = (
            (sums[ends] - sums[starts]) % prime * down[starts] % prime
            for prime, sums, down in zip(PRIMES, self.sums, self.down, strict=True)
        )
        return one << np.uint64(31) | two


def _checked(values, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The checks of ascending stretches, block by block, as one needs little memory;
    ``values(a, b)`` of a part of the sequence modulo each prime."""
    found = np.zeros(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, int(starts[-1]) + CHECK_BLOCK + 1, CHECK_BLOCK)) if len(starts) else [0]
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        if y > x:
            a, b = int(starts[x]), int(ends[y - 1])
            found[x:y] = Checks(values(a, b)).windows(starts[x:y] - a, ends[x:y] - a)
    return found


def checks_of_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _checked(lambda a, b: [letters[data[a:b]] for letters in _CHECKED_LETTER], starts, ends)


def checks_of(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _checked(lambda a, b: [mixed(values[a:b]) % prime for prime in PRIMES], starts, ends)


def of_bytes(data: np.ndarray) -> Rolling:
    return Rolling(_LETTER[data])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes of UTF-8 are never in that range."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts, and the n + 1 offsets of each text's words.

    A word is a longest run of bytes other than blank and \\x09-\\x0D.
    """
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return of_bytes(data).windows(starts, ends) + (ends - starts).astype(np.uint64)


def safe_word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word hashes that hold for patterned words too: those of long words take in their checks."""
    found = word_hashes(data, starts, ends)
    long = np.flatnonzero(ends - starts > PLAIN_BYTES)
    found[long] ^= mixed(checks_of_bytes(data, starts[long], ends[long]))
    return found


def word_checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return checks_of_bytes(data, starts, ends) + (ends - starts).astype(np.uint64)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as gaps, byte by byte, without empty high bytes."""
    if len(keys) == 0:
        return b""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    head = gaps[0]
    gaps[0] = 0
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    planes = gaps.view(np.uint8).reshape(-1, 8)[:, :width].T
    return head.tobytes() + bytes([width]) + np.ascontiguousarray(planes).tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    width = packed[8]
    planes = np.frombuffer(packed, np.uint8, offset=9).reshape(width, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :width] = planes.T
    values = gaps.view("<u8").ravel().astype(np.uint64)
    values[0] = np.frombuffer(packed, "<u8", 1)[0]
    return np.cumsum(values)
