"""Word shingles and MinHash signatures of whole texts, on arrays of bytes."""

from __future__ import annotations

import hashlib

import numpy as np

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)
#: Texts are worked on together up to so many bytes.
BATCH_BYTES = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal(text: str | None) -> bytes:
    """A-Z lower-cased, words (anything but \\x20 and \\x09-\\x0D) joined by one space."""
    return b" ".join((text or "").encode().translate(_LOWER).split())


def class_key(words: bytes) -> tuple[int, int]:
    digest = hashlib.blake2b(words, digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _powers(n: int) -> np.ndarray:
    out = np.repeat(_BASE, n)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(1 << 12)
_WEIGHTS = _mix(np.arange(200, dtype=np.uint64) * _BASE)


def _word_hashes(words: bytes) -> np.ndarray:
    """64-bit hash of each word of normal bytes."""
    b = np.frombuffer(words, np.uint8)
    gap = np.flatnonzero(b == 32)
    starts = np.r_[0, gap + 1]
    lengths = np.diff(np.r_[starts, len(b) + 1])
    place = np.arange(len(b)) - np.repeat(starts, lengths)[: len(b)]
    power = _POWERS if lengths.max() < len(_POWERS) else _powers(int(lengths.max()) + 1)
    value = (b.astype(np.uint64) + np.uint64(1)) * power[place]
    value[gap] = 0
    return _mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64))


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each normal text; of fewer words, the sequence as one; of none, nothing."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    start, held = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or (held and held + len(texts[i]) > BATCH_BYTES):
            _sets(texts, start, i, size, out)
            start, held = i, 0
        if i < len(texts):
            held += len(texts[i])
    return out


def _sets(texts: list[bytes], start: int, end: int, size: int, out: list[np.ndarray]) -> None:
    index = [i for i in range(start, end) if texts[i]]
    if not index:
        return
    h = _word_hashes(b" ".join(texts[i] for i in index))
    counts = np.array([texts[i].count(b" ") + 1 for i in index])
    s = np.zeros(len(h), np.uint64)
    for k in range(size):
        shifted = h[k:] if k else h
        s[: len(shifted)] += shifted * _WEIGHTS[k + 1]
    s = _mix(s)
    at = 0
    for i, n in zip(index, counts):
        if n >= size:
            out[i] = np.unique(s[at : at + n - size + 1])
        else:
            weighted = h[at : at + n] * _WEIGHTS[101 : 101 + n]
            out[i] = _mix(weighted.sum(keepdims=True) + np.uint64(n))
        at += n


def multipliers(count: int) -> np.ndarray:
    return _mix(np.arange(1, count + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash values (32 bits), one row per set; sets must not be empty."""
    out = np.empty((len(sets), count), np.uint32)
    a = multipliers(count)
    start, held = 0, 0
    for i in range(len(sets) + 1):
        if i == len(sets) or (held and held + len(sets[i]) > BATCH_BYTES // 4):
            if i > start:
                h = np.concatenate(sets[start:i])
                begin = np.cumsum([0, *map(len, sets[start : i - 1])])
                for k in range(count):
                    out[start:i, k] = np.minimum.reduceat(_mul_high(h, a[k]), begin)
            start, held = i, 0
        if i < len(sets):
            held += len(sets[i])
    return out


def _mul_high(h: np.ndarray, a: np.uint64) -> np.ndarray:
    return ((h * a) >> np.uint64(32)).astype(np.uint32)
