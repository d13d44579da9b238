"""Rounds of recompression over the sequences of a block.

A round replaces maximal runs of one symbol by a new symbol, then pairs whose left symbol
is in one half of the alphabet and whose right is in the other. Names of runs and pairs
are hashes of their parts and the halves are bits of names and round, so every task names
alike and equal names stand for equal words.

What lies inside a piece of a sequence is joined alike wherever the piece stands; only at
its two ends the joins depend on what is around it. ``Symbols.names_of`` takes these ends
off, round by round, and keeps them: what was taken off, in order, is the piece written in
the largest symbols that are sure to lie in it. Equal pieces have equal such sequences,
and different pieces different ones, so the name made of a sequence names the piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from hemline.llm.common import mix

_RUN = np.uint64(0xA24BAED4963EE407)
_PAIR = np.uint64(0x9FB21C651E98DF25)
_CHAIN = np.uint64(0x8EBC6AF09C88C6E3)
_FAR = 1 << 40


@dataclass
class Round:
    """One round: the symbols that enter, their runs, and the symbols that leave."""

    names: np.ndarray   # of the symbols that enter
    run: np.ndarray     # run of each of them
    begin: np.ndarray   # first symbol of each run
    end: np.ndarray     # behind the last one
    runs: np.ndarray    # name of each run
    row: np.ndarray     # row of each run
    right: np.ndarray   # whether a run is in the right half
    place: np.ndarray   # symbol that each run goes into
    first: np.ndarray   # first run of each symbol that leaves
    joined: np.ndarray  # whether that is a pair
    made: np.ndarray    # name of each symbol that leaves


def one_round(names: np.ndarray, row: np.ndarray, level: int) -> Round:
    """Joins the symbols of each row; ``level`` numbers the round."""
    head = np.ones(len(names), bool)
    head[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(head)
    end = np.append(begin[1:], len(names)) if len(begin) else begin
    length = (end - begin).astype(np.uint64)
    with np.errstate(over="ignore"):
        runs = np.where(length > 1, mix(names[begin] + length * _RUN), names[begin])
        right = (mix(runs + np.uint64(level + 1)) >> np.uint64(63)).astype(bool)
    rows = row[begin]
    pair = np.zeros(len(runs), bool)
    pair[:-1] = ~right[:-1] & right[1:] & (rows[:-1] == rows[1:])
    second = np.zeros(len(runs), bool)
    second[1:] = pair[:-1]
    first = np.flatnonzero(~second)
    joined = pair[first]
    follower = np.minimum(first + 1, max(len(runs) - 1, 0))
    with np.errstate(over="ignore"):
        made = np.where(joined, mix(runs[first] * _PAIR + mix(runs[follower])), runs[first])
    return Round(names, np.cumsum(head) - 1, begin, end, runs, rows, right, np.cumsum(~second) - 1, first, joined, made)


def _chain(so_far: np.ndarray, names: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(so_far * _CHAIN + mix(names + np.asarray(count, np.uint64) * _RUN) + np.uint64(1))


class Symbols:
    """The rounds of a block's sequences, made when they are first asked for."""

    def __init__(self, names: np.ndarray, row: np.ndarray, level: int = 0):
        self._names, self._row, self._level = names, row, level
        self._rounds: list[Round] = []

    def round(self, index: int) -> Round:
        while len(self._rounds) <= index:
            names, row = self._names, self._row
            if self._rounds:
                last = self._rounds[-1]
                names, row = last.made, last.row[last.first]
            self._rounds.append(one_round(names, row, self._level + len(self._rounds)))
        return self._rounds[index]

    def after(self, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Name and first entering symbol of every symbol after the rounds."""
        start = np.arange(len(self._names))
        for index in range(rounds):
            at = self.round(index)
            start = start[at.begin[at.first]]
        return self.round(rounds - 1).made, start

    def safe(self, rounds: int) -> tuple[np.ndarray, ...]:
        """Name, first word, and the words [low, high) that each symbol after the rounds depends on.

        At a row's edges a symbol depends on words that do not exist: low or high is far away.
        """
        names = self._names
        start = np.arange(len(names))
        low, high = start, start + 1
        for index in range(rounds):
            at = self.round(index)
            # a run is maximal by its neighbours
            edge = np.ones(len(at.row) + 1, bool)
            edge[1:-1] = at.row[1:] != at.row[:-1]
            low, high = (np.where(edge[:-1], -_FAR, low[np.maximum(at.begin - 1, 0)]),
                         np.where(edge[1:], _FAR, high[np.minimum(at.end, len(at.names) - 1)]))
            # a pair depends on its parts; a symbol left alone depends on its neighbours too
            row, one = at.row[at.first], at.first
            edge = np.ones(len(row) + 1, bool)
            edge[1:-1] = row[1:] != row[:-1]
            follower = np.minimum(one + 1, max(len(at.row) - 1, 0))
            low, high = (np.where(at.joined, low[one], np.where(edge[:-1], -_FAR, low[np.maximum(one - 1, 0)])),
                         np.where(at.joined, high[follower], np.where(edge[1:], _FAR, high[follower])))
            names, start = at.made, start[at.begin[one]]
        return names, start, low, high

    def names_of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The name of each piece [lo, hi) of a row, made of the symbols inside it."""
        left, right = np.zeros(len(lo), np.uint64), np.zeros(len(lo), np.uint64)
        live = np.flatnonzero(hi > lo)
        a, b = lo[live], hi[live]
        index = 0
        while len(live):
            at = self.round(index)
            # what the piece holds of its first and its last run
            run, last = at.run[a], at.run[b - 1]
            left[live] = _chain(left[live], at.names[a], np.minimum(at.end[run], b) - a)
            two = last > run
            live, a, b, run, last = live[two], a[two], b[two], run[two], last[two]
            right[live] = _chain(right[live], at.names[b - 1], b - at.begin[last])
            a, b = run + 1, last
            some = a < b
            live, a, b = live[some], a[some], b[some]
            # an end that could pair with a neighbour outside
            out = at.right[a]
            left[live[out]] = _chain(left[live[out]], at.runs[a[out]], 0)
            a = a + out
            some = a < b
            live, a, b = live[some], a[some], b[some]
            out = ~at.right[b - 1]
            right[live[out]] = _chain(right[live[out]], at.runs[b[out] - 1], 0)
            b = b - out
            some = a < b
            live, a, b = live[some], a[some], b[some]
            a, b = at.place[a], at.place[b - 1] + 1
            index += 1
        return _chain(left, right, 1)
