"""CRC-32C over many byte strings at once, and the masked form of record files.

The checksum is linear, so blocks are taken as columns of words, moved to their
place by matrices over bits, and folded per message.
"""

from __future__ import annotations

import numpy as np

POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
BLOCK = 256
ONES = np.uint32(0xFFFFFFFF)


def _by_bits(images: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where((x >> np.uint32(bit)) & np.uint32(1), images[bit], np.uint32(0))
    return out


def _zero_byte() -> np.ndarray:
    """Images of the 32 register bits after one zero byte."""
    x = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), (x >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), x >> np.uint32(1))
    return x


def _powers(count: int) -> list[np.ndarray]:
    """Images after 1, 2, 4, ... zero bytes."""
    out = [_zero_byte()]
    while len(out) < count:
        out.append(_by_bits(out[-1], out[-1]))
    return out


def _half_table(images: np.ndarray) -> np.ndarray:
    out = np.zeros(1, np.uint32)
    for image in images:
        out = np.concatenate([out, out ^ image])
    return out


AFTER = _powers(48)
LOW, HIGH = _half_table(AFTER[2][:16]), _half_table(AFTER[2][16:])
BLOCK_BIT = BLOCK.bit_length() - 1


def crc32c(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of data[start:start + length] for each message, as uint32."""
    count = len(lengths)
    if not count:
        return np.zeros(0, np.uint32)
    blocks = np.maximum(1, -(-lengths // BLOCK))
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    padded = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)  # zeros in front leave an empty register empty
    ends = (first + blocks) * BLOCK
    for start, length, end in zip(starts.tolist(), lengths.tolist(), ends.tolist()):
        padded[end - length:end] = data[start:start + length]
    words = padded.view("<u4").reshape(-1, BLOCK // 4)
    register = np.zeros(len(words), np.uint32)
    for i in range(words.shape[1]):
        register ^= words[:, i]
        register = LOW[register & np.uint32(0xFFFF)] ^ HIGH[register >> np.uint32(16)]
    behind = np.repeat(first + blocks - 1, blocks) - np.arange(len(words))
    bit = 0
    while (behind >> bit).any():
        move = np.flatnonzero((behind >> bit) & 1)
        register[move] = _by_bits(AFTER[BLOCK_BIT + bit], register[move])
        bit += 1
    folded = np.bitwise_xor.reduceat(register, first)
    opening = np.full(count, ONES)
    bit = 0
    while (lengths >> bit).any():
        move = np.flatnonzero((lengths >> bit) & 1)
        opening[move] = _by_bits(AFTER[bit], opening[move])
        bit += 1
    return folded ^ opening ^ ONES


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
