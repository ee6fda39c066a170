"""CRC-32 of many byte spans at once, and of their concatenations without touching the bytes again.

A CRC is linear: the sum of ``a`` followed by ``b`` is that of ``a`` carried over as many zero bytes as ``b`` has, combined
with that of ``b``. Carrying over is a table look-up for each byte of the sum.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

#: Fixed value: the CRC-32 polynomial, lowest bit first.
POLYNOMIAL = 0xEDB88320
_SHORT = 64  # lengths below go through one table, the rest is carried over by powers of two
_U8, _U255 = np.uint32(8), np.uint32(255)


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sums of single bytes, the carry over 0 to 63 bytes, and over 64, 128, 256 ... bytes, per byte of the sum."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), step >> np.uint32(1))
    carry = np.zeros((_SHORT + 1, 4, 256), np.uint32)
    for k in range(4):
        carry[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for length in range(1, _SHORT + 1):
        carry[length] = step[carry[length - 1] & _U255] ^ (carry[length - 1] >> _U8)
    powers = [carry[_SHORT]]
    for _ in range(40):
        powers.append(_look_up(powers[-1], powers[-1]))
    return step, carry[:_SHORT], np.array(powers)


def _look_up(table: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return table[0][sums & _U255] ^ table[1][(sums >> _U8) & _U255] ^ table[2][(sums >> np.uint32(16)) & _U255] ^ table[3][sums >> np.uint32(24)]


def span_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``."""
    step, _, _ = _tables()
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    many = np.searchsorted(-length[order], -np.arange(_SHORT), "left")  # how many spans are longer than j bytes
    long = order[: int((length > _SHORT).sum())]
    for j in range(_SHORT):
        at = order[len(long) : many[j]]
        if not len(at):
            break
        out[at] = step[(out[at] ^ data[starts[at] + j]) & _U255] ^ (out[at] >> _U8)
    out ^= np.uint32(0xFFFFFFFF)
    if len(long):
        held = memoryview(np.ascontiguousarray(data))
        out[long] = [zlib.crc32(held[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return out


def joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The sums of spans followed by spans of ``length`` bytes, from the sums of both."""
    _, carry, powers = _tables()
    short = length % _SHORT
    out = (carry[short, 0, first & _U255] ^ carry[short, 1, (first >> _U8) & _U255] ^ carry[short, 2, (first >> np.uint32(16)) & _U255]
           ^ carry[short, 3, first >> np.uint32(24)])
    rest = length // _SHORT
    for k in range(int(rest.max(initial=0)).bit_length()):
        some = np.flatnonzero((rest >> k) & 1)
        out[some] = _look_up(powers[k], out[some])
    return out ^ second
