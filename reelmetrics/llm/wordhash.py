"""64-bit hashes of the words of texts, many at a time. Words end at blanks; A-Z count as a-z."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes begin, and how long they are."""
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2] - edges[::2]


def hash_places(data: bytes, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the words of lower-case bytes at some places.

    Eight bytes of all words are taken in at a time, so the work grows with the words, not with the bytes.
    """
    padded = np.frombuffer(data + bytes(8), np.uint8)
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    with np.errstate(over="ignore"):
        hashes = mixed(lengths.astype(np.uint64) * _FIRST + np.uint64(seed))
        at, left, which = starts, lengths, np.arange(len(starts))
        while len(which):
            # Of the last piece of a word only its own bytes count.
            spare = (8 * np.maximum(8 - left, 0)).astype(np.uint64)
            pieces = (eights[at] << spare) >> spare
            hashes[which] = mixed(hashes[which] * _SECOND + pieces)
            more = (left > 8) & (lengths[which] <= LONG_WORD)
            at, left, which = at[more] + 8, left[more] - 8, which[more]
        for i in np.flatnonzero(lengths > LONG_WORD):
            hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]], seed)
    return hashes


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text in their order."""
    text = text.lower()
    return hash_places(text, *word_places(text))


def blocks(texts: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """The texts in runs of about ``size`` bytes; a longer text is a run of its own."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text) > size:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


def words_of_texts(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in small letters, one behind the other, where their words begin, how long they are, and
    the number of words before each text and behind the last one."""
    data = b" ".join(texts).lower()
    starts, lengths = word_places(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, lengths, np.concatenate([[0], np.searchsorted(starts, ends)])
