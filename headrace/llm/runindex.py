"""A run-length index of texts and matching statistics by streaming.

The suffixes of a set of short texts are sorted, and the symbols in front of them, the
Burrows-Wheeler transform, are kept as runs: symbol, first row, length, rows of the symbol
before it, and the text positions of the first and the last row of the run. The suffix array
itself is dropped. Texts that repeat each other give few runs.

A pattern is read from its end. The state is a row, its text position and the length of the
match there. If the symbol in front is the pattern's next one, the match grows by a step in the
transform. Otherwise the longest match for the next symbol is at the end of the run of it before
the row or at the start of the one behind, whose positions are sampled: the one that shares
more with the present match is taken. So every pattern position gets the length of its longest
match in the texts, and a row of it. All patterns of a set take their steps together, in numpy.

Rows whose suffixes agree in their first ``depth`` symbols lie one behind the other; of each
such stretch the least of the texts' marks (their documents) is kept for its rows. So a
match of that length leads to the earliest document that has it, however many there are.
"""

from __future__ import annotations

import numpy as np

WIDTH = 9  # bits of a symbol: a byte plus one; 0 ends a text
FIRST = 7  # symbols that are compared at once
SHIFT = np.int64(40)  # room for rows below the symbol in the keys of runs


def _ragged(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of each item of lists of these sizes."""
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)


def symbols(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts as symbols, each text ended by a zero, and where the texts begin."""
    owner, place = _ragged(size + 1)
    begin = np.cumsum(size + 1) - (size + 1)
    out = np.zeros(len(owner), np.int16)
    inner = place < size[owner]
    out[inner] = data[(start[owner] + place)[inner]].astype(np.int16) + 1
    return out, begin


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of texts that end in zeros; of equal ones the earlier text comes first."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    end = np.repeat(ends, np.diff(ends, prepend=-1))
    wide = text.astype(np.int64)
    key = np.zeros(n, np.int64)
    for j in range(FIRST):
        key = key << WIDTH | wide[np.minimum(np.arange(n) + j, end)]
    # Ends have key 0 at first; then, and always in their ranks, they are in order of their texts.
    tied = len(ends) - 1
    depth = FIRST
    # Two ranks and a position fit one number, which sorts several times faster than by an order.
    bits = np.int64(max(n, 1).bit_length())
    packed = 3 * bits <= 63
    order = np.argsort(key)
    sorted_ = key[order]
    while True:
        new = np.append(True, sorted_[1:] != sorted_[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1 + tied
        rank[ends] = np.arange(len(ends))
        if np.count_nonzero(new) + tied == n:
            order[rank] = np.arange(n)
            return order
        key = rank << (bits if packed else np.int64(32)) | rank[np.minimum(np.arange(n) + depth, end)]
        key[ends] = np.arange(len(ends))
        if packed:
            both = np.sort(key << bits | np.arange(n))
            order, sorted_ = both & ((1 << bits) - 1), both >> bits
        else:
            order = np.argsort(key)
            sorted_ = key[order]
        tied = 0
        depth *= 2


class RunIndex:
    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, marks: np.ndarray, depth: int):
        self.text, _ = symbols(data, start, size)
        # Four symbols a word, for comparing positions.
        padded = np.append(self.text, np.zeros(8, np.int16))
        self.words = np.ndarray(len(self.text) + 4, "<u8", padded.tobytes(), strides=(2,))
        rows = suffix_order(self.text)
        agree = self.shared(rows[:-1], rows[1:], np.full(len(rows) - 1, depth))
        stretch = np.append(0, np.flatnonzero(agree < depth) + 1)
        least = np.minimum.reduceat(np.repeat(marks, size + 1)[rows], stretch)
        self.least = np.repeat(least, np.diff(np.append(stretch, len(rows))))
        front = self.text[rows - 1]  # in front of the first text is the end of the last one
        first = np.flatnonzero(np.append(True, front[1:] != front[:-1]))
        length = np.diff(np.append(first, len(front)))
        symbol = front[first].astype(np.int64)
        by = np.lexsort((first, symbol))
        self.n_runs = len(by)
        self.key = (symbol << SHIFT | first)[by]
        self.start, self.length = first[by], length[by]
        before = np.cumsum(self.length) - self.length
        smaller = np.searchsorted(symbol[by], np.arange(258))
        counts = np.append(before, len(front))[smaller]
        self.before = before - counts[symbol[by]]
        self.first_of = counts  # rows whose suffix begins with a smaller symbol
        self.head, self.tail = rows[first][by], rows[first + length - 1][by]
        self.anchor = int(rows[0])

    def least_mark(self, row: np.ndarray) -> np.ndarray:
        """The least mark of the texts that share ``depth`` symbols with the suffixes of some rows."""
        return self.least[row]

    def shared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols agree from two positions on, up to ``most``."""
        out = np.zeros(len(a), np.int64)
        left = np.flatnonzero(most > 0)
        while len(left):
            differ = self.words[a[left] + out[left]] ^ self.words[b[left] + out[left]]
            low = differ & (~differ + np.uint64(1))
            agree = np.where(differ == 0, 4, np.bitwise_count(low - np.uint64(1)) >> 4).astype(np.int64)
            out[left] += agree
            left = left[(agree == 4) & (out[left] < most[left])]
        return np.minimum(out, most)

    def matches(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each byte of each pattern, one behind the other, the length of its longest match, and
        a row whose suffix begins with that match."""
        offset = np.cumsum(size) - size
        out, rows = np.zeros(int(size.sum()), np.int64), np.zeros(int(size.sum()), np.int64)
        by = np.argsort(-size, kind="stable")
        start, size, offset = start[by], size[by], offset[by]
        n = len(size)
        row, at = np.zeros(n, np.int64), np.full(n, self.anchor, np.int64)
        length = np.zeros(n, np.int64)
        for step in range(int(size[0]) if n else 0):
            n = int(np.searchsorted(-size, -step))  # patterns with more than ``step`` bytes
            row, at, length = row[:n], at[:n], length[:n]
            place = size[:n] - 1 - step
            symbol = data[start[:n] + place].astype(np.int64) + 1
            run = np.searchsorted(self.key, symbol << SHIFT | row, "right") - 1
            held = np.maximum(run, 0)
            earlier = (run >= 0) & (self.key[held] >> SHIFT == symbol)
            inside = earlier & (row < self.start[held] + self.length[held])
            to = self.first_of[symbol] + self.before[held] + row - self.start[held]
            new_row, new_at, new_length = np.where(inside, to, 0), at - 1, length + 1
            out_of = np.flatnonzero(~inside)
            if len(out_of):
                k, c, p, most = held[out_of], symbol[out_of], at[out_of], length[out_of]
                up = earlier[out_of]
                behind = np.minimum(run[out_of] + 1, self.n_runs - 1)
                down = (run[out_of] + 1 < self.n_runs) & (self.key[behind] >> SHIFT == c)
                l_up = np.where(up, self.shared(p, self.tail[k], np.where(up, most, 0)), -1)
                l_down = np.where(down, self.shared(p, self.head[behind], np.where(down, most, 0)), -1)
                use_up = l_up >= l_down
                some = up | down
                to_up = self.first_of[c] + self.before[k] + self.length[k] - 1
                to_down = self.first_of[c] + self.before[behind]
                new_row[out_of] = np.where(some, np.where(use_up, to_up, to_down), 0)
                sample = np.where(use_up, self.tail[k], self.head[behind]) - 1
                new_at[out_of] = np.where(some, sample, self.anchor)
                new_length[out_of] = np.where(some, np.maximum(l_up, l_down) + 1, 0)
            row, at, length = new_row, new_at, new_length
            out[offset[:n] + place] = length
            rows[offset[:n] + place] = row
        return out, rows
