"""Compact n-gram levels: Elias-Fano sequences and tries made of them.

A level is one flat buffer that is used in place, from bytes or from a memory-mapped file:
nothing is parsed into objects. Reading touches only the blocks that a search needs.
"""

from __future__ import annotations

import numpy as np

#: elements between two entries of a sequence's directory
STEP = 512
#: directory blocks that are decoded together, which bounds the memory of a search
SPAN = 128
CODES = 256


class EliasFano:
    """A non-decreasing sequence of unsigned integers in about 2 + log2(universe / n) bits each."""

    def __init__(self, words: np.ndarray):
        self.n, self.low_bits, self.high_bits = (int(x) for x in words[:3])
        blocks = -(-self.n // STEP)
        low_words = (self.n * self.low_bits + 63) // 64 + 1
        at = 3
        self.first = words[at : at + blocks]
        self.place = words[at + blocks : at + 2 * blocks]
        at += 2 * blocks
        self.low = words[at : at + low_words]
        at += low_words
        high_words = -(-self.high_bits // 64)
        self.high = words[at : at + high_words].view(np.uint8)
        self.size = at + high_words

    @staticmethod
    def build(values: np.ndarray) -> np.ndarray:
        """The sequence as 64-bit words."""
        values = values.astype(np.uint64, copy=False)
        n = len(values)
        low_bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1) if n else 0
        high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high_bits = int(high[-1]) + 1 if n else 0
        marks = np.zeros(-(-high_bits // 64) * 64, np.uint8)
        marks[high] = 1
        head = np.array([n, low_bits, high_bits], np.uint64)
        parts = [head, values[::STEP], high[::STEP].astype(np.uint64), _packed(values, low_bits)]
        return np.concatenate([*parts, np.packbits(marks, bitorder="little").view(np.uint64)])

    def slice(self, begin: int, end: int) -> np.ndarray:
        """Elements ``begin`` to ``end`` (exclusive)."""
        end = min(end, self.n)
        if begin >= end:
            return np.empty(0, np.uint64)
        block = begin // STEP
        origin = int(self.place[block]) // 8
        last = -(-end // STEP)
        stop = int(self.place[last]) if last < len(self.place) else self.high_bits
        marks = np.unpackbits(self.high[origin : -(-stop // 8)], bitorder="little")
        found = np.flatnonzero(marks) + origin * 8
        found = found[found >= int(self.place[block])][begin - block * STEP : end - block * STEP]
        index = np.arange(begin, end)
        high = (found - index).astype(np.uint64) << np.uint64(self.low_bits)
        return high | _unpacked(self.low, index, self.low_bits)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """For ascending values, the index of each in a strictly ascending sequence, or -1.

        The directory gives the block of each value's successor; blocks are decoded in spans.
        """
        out = np.full(len(wanted), -1, np.int64)
        if not self.n or not len(wanted):
            return out
        block = np.maximum(np.searchsorted(self.first, wanted, side="right") - 1, 0)
        spans = block // SPAN
        starts = np.flatnonzero(np.concatenate([[True], spans[1:] != spans[:-1]]))
        for begin, end in zip(starts, np.append(starts[1:], len(wanted)), strict=True):
            base = int(block[begin]) * STEP
            held = self.slice(base, (int(block[end - 1]) + 1) * STEP)
            asked = wanted[begin:end]
            successor = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            out[begin:end] = np.where(held[successor] == asked, successor + base, -1)
        return out


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros((len(values) * bits + 63) // 64 + 1, np.uint64)
    if bits and len(values):
        low = values & np.uint64((1 << bits) - 1)
        at = np.arange(len(values)) * bits
        word, offset = at >> 6, (at & 63).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(low << offset, first)
        over = offset + np.uint64(bits) > 64  # at most one value reaches into a word from the one before
        out[word[over] + 1] |= low[over] >> (np.uint64(64) - offset[over])
    return out


def _unpacked(words: np.ndarray, index: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(index), np.uint64)
    at = index * bits
    word, offset = at >> 6, (at & 63).astype(np.uint64)
    low = words[word] >> offset
    rest = np.where(offset > 0, words[word + 1] << ((np.uint64(64) - offset) & np.uint64(63)), np.uint64(0))
    return (low | rest) & np.uint64((1 << bits) - 1)


def ranked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in ascending order, and each value's place among them.

    Sorts single numbers, the values' first bits with their places behind. Values that these bits don't tell apart
    (a few among millions of hashes) are sorted in full.
    """
    values = hashes.astype(np.uint64, copy=False)
    bits = np.uint64(len(values).bit_length())
    by = values >> bits << bits | np.arange(len(values), dtype=np.uint64)
    by.sort()
    by = (by & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    held = values[by]
    if (held[1:] < held[:-1]).any():
        return np.unique(hashes, return_inverse=True)
    fresh = np.ones(len(held), bool)
    fresh[1:] = held[1:] != held[:-1]
    place = np.empty(len(held), np.int64)
    place[by] = np.cumsum(fresh) - 1
    return held[fresh], place


def quantised(logs: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Codes 1 to 255 for logarithms, evenly spaced between the smallest and the largest."""
    low, high = (float(logs.min()), float(logs.max())) if len(logs) else (0.0, 0.0)
    step = (high - low) / (CODES - 2) or 1.0
    return (np.rint((logs - low) / step) + 1).astype(np.uint8), low, step


class TrieLevel:
    """All n-grams of one order in one shard: contexts, and the words that follow each.

    A word is stored relative to its context: as the rank in the shard's vocabulary, plus the
    context's number times the vocabulary's size. So the words of all contexts are one ascending
    sequence, and looking a word up is a successor search among those of its context. Pointers
    give each context's stretch and so its number of different words.
    """

    def __init__(self, buffer):
        words = np.frombuffer(buffer, np.uint64) if not isinstance(buffer, np.ndarray) else buffer
        self.parts = []
        at = 1
        for _ in range(4):
            self.parts.append(EliasFano(words[at:]))
            at += self.parts[-1].size
        self.contexts, self.pointers, self.vocabulary, self.followers = self.parts
        self.totals = words[at : at + self.contexts.n]
        at += self.contexts.n
        self.low, self.step = words[at : at + 2].view(np.float64)
        at += 2
        self.exact = bool(words[0])
        self.values = words[at:] if self.exact else words[at:].view(np.uint8)[: self.followers.n]

    @classmethod
    def open(cls, path: str) -> TrieLevel:
        """A level in a file, mapped into memory."""
        return cls(np.memmap(path, np.uint64, "r"))

    @staticmethod
    def build(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, discount: float, exact: bool) -> bytes:
        """From distinct (context, word) pairs in ascending order.

        Values are the counts where ``exact``, else quantised log10((count - discount) / total of the context).
        """
        is_first = np.concatenate([[True], contexts[1:] != contexts[:-1]])[: len(contexts)]
        starts = np.flatnonzero(is_first)
        number = np.cumsum(is_first) - 1
        vocabulary, rank = ranked(words)
        followers = number.astype(np.uint64) * np.uint64(len(vocabulary)) + rank.astype(np.uint64)
        totals = np.add.reduceat(counts, starts) if len(starts) else np.empty(0, np.int64)
        if exact:
            values, low, step = counts.astype(np.uint64), 0.0, 0.0
        else:
            codes, low, step = quantised(np.log10((counts - discount) / totals[number]))
            values = np.frombuffer(codes.tobytes() + b"\0" * (-len(codes) % 8), np.uint64)
        pointers = np.append(starts, len(contexts)) if len(starts) else starts
        sequences = [EliasFano.build(x) for x in (contexts[starts], pointers, vocabulary, followers)]
        head, scale = np.array([exact], np.uint64), np.array([low, step]).view(np.uint64)
        return np.concatenate([head, *sequences, totals.astype(np.uint64), scale, values]).tobytes()

    def find_contexts(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number or -1, total count, different words) of ascending contexts."""
        number = self.contexts.find(contexts)
        total, kinds = np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64)
        held = number >= 0
        if held.any():
            total[held] = self.totals[number[held]].astype(np.int64)
            begin, end = int(number[held].min()), int(number[held].max()) + 2
            pointers = self.pointers.slice(begin, end).astype(np.int64)
            kinds[held] = np.diff(pointers)[number[held] - begin]
        return number, total, kinds

    def find(self, numbers: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Index of each (context number, word) pair, ascending in both, or -1."""
        return self.find_among(numbers, *np.unique(words, return_inverse=True))

    def find_among(self, numbers: np.ndarray, distinct: np.ndarray, place: np.ndarray) -> np.ndarray:
        """``find`` for words that are given as places in an ascending list."""
        rank = self.vocabulary.find(distinct)[place]
        out = np.full(len(place), -1, np.int64)
        known = (rank >= 0) & (numbers >= 0)
        wanted = numbers[known].astype(np.uint64) * np.uint64(self.vocabulary.n) + rank[known].astype(np.uint64)
        out[known] = self.followers.find(wanted)
        return out
