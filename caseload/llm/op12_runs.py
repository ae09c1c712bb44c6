"""Periodic runs of words, found with a recompressed grammar.

A run is a stretch of consecutive words whose smallest period is q (words q apart are equal), at
least ``max(LEAST, TIMES * q)`` words long, that neither neighbour extends.

* ``Grammar`` compresses a string of word numbers level by level: equal neighbours become one
  symbol with a count (blocks), then names are dealt to a left and a right side and every left name
  that meets a right one becomes one symbol with it (pairs). A name stands for one text of words and
  one only, so comparing names never errs. Symbols that lie alike inside equal stretches are made
  alike, but for a few at the borders.
* ``Grammar.extend`` tells how far two places agree, forwards or backwards: it climbs while both
  stand at the edge of equal symbols, takes whole blocks at once, and falls back to words at the end.
  Its steps grow with the levels, not with the words that agree.
* ``harmonic`` gives candidates: for a period p, places ``max(3 p, LEAST - p)`` apart, which every run
  of that period crosses; all periods together have about n ln(n) / 3. A candidate whose words p
  apart agree is extended both ways. The smallest period found for a stretch is its own: a larger
  one that repeats four times is a multiple of it.

Documents of a block lie in one string with a mark of its own between any two, so no run
crosses. Memory follows the block (``BLOCK`` bytes) or the longest document, about 60 bytes a word.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has no runs and collapses to the
empty text; texts are taken whole; rows that repeat are treated each; null ids are kept; other columns
pass through untouched, but for columns named ``runs`` and ``collapsed``, which are replaced; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from .common import blocks, in_arrow, mix, ship, texts_of

LEAST = 6
TIMES = 4
GRID = 1 << 20  # candidates made at once
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class Grammar:
    """Run-length grammar of ``word``: its first and last symbol, and all of ``marks`` on, must
    occur once each."""

    def __init__(self, word: np.ndarray, marks: int):
        levels, firsts, kinds = [word.astype(np.int32)], [], []
        names, done, pairs = int(word.max()) + 1, int((word >= marks).sum()) * 2, False
        ends, stalled = int(word.max()) + 1, 0
        while len(levels[-1]) > done and stalled < 4:
            now = levels[-1]
            made = self._pairs(now, names, marks, ends, len(levels)) if pairs else self._blocks(now, names)
            stalled = 0 if made else stalled + 1
            if made:
                level, first, names = made
                levels.append(level)
                firsts.append(first)
                kinds.append(not pairs)
            pairs = not pairs
        sizes = [len(x) for x in levels]
        base = np.concatenate([[0], np.cumsum(sizes)])
        self.words, total = sizes[0], int(base[-1])
        self.name = np.concatenate(levels)
        self.up = np.full(total, -1, np.int32)
        self.first = np.full(total + 1, -1, np.int32)
        self.block = np.zeros(total, bool)  # does the symbol above hold equal symbols?
        for h, (first, kind) in enumerate(zip(firsts, kinds)):
            low, high = int(base[h + 1]), int(base[h + 2])
            self.first[low:high] = first + base[h]
            parent = np.repeat(np.arange(low, high, dtype=np.int32), np.diff(np.append(first, sizes[h])))
            self.up[base[h] : base[h + 1]] = parent
            self.block[base[h] : base[h + 1]] = kind

    @staticmethod
    def _blocks(now: np.ndarray, names: int):
        first = np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]]))
        if len(first) == len(now):
            return None
        length = np.diff(np.append(first, len(now)))
        level, many = now[first], length > 1
        known, at = np.unique(level[many].astype(np.int64) * (len(now) + 1) + length[many], return_inverse=True)
        level[many] = names + at
        return level, first, names + len(known)

    @staticmethod
    def _pairs(now: np.ndarray, names: int, marks: int, ends: int, seed: int):
        side = (mix(now.astype(np.uint64) + np.uint64(seed * 0x9E3779B9)) >> np.uint64(63)).astype(np.int8)
        side[(now >= marks) & (now < ends)] = 2  # marks stay alone
        one = (side[:-1] == 0) & (side[1:] == 1)
        other = (side[:-1] == 1) & (side[1:] == 0)
        head = np.flatnonzero(one if one.sum() >= other.sum() else other)
        if not len(head):
            return None
        stays = np.ones(len(now), bool)
        stays[head + 1] = False
        known, at = np.unique(now[head].astype(np.int64) * names + now[head + 1], return_inverse=True)
        level = now.copy()
        level[head] = names + at
        return level[stays], np.flatnonzero(stays), names + len(known)

    def extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many words from place a on (``step`` 1) or back (-1) agree with those at b. a < b."""
        name, up, first, block = self.name, self.up, self.first, self.block
        out, place = np.zeros(len(a), np.int64), np.arange(len(a))
        origin, x, y = a, a, b
        climbs = np.ones(len(a), bool)
        while len(place):
            same = name[x] == name[y]
            over, under = up[x], up[y]
            if step > 0:
                edge = (first[over] == x) & (first[under] == y)
                left = np.minimum(first[over + 1] - x, first[under + 1] - y)
            else:
                edge = (first[over + 1] - 1 == x) & (first[under + 1] - 1 == y)
                left = np.minimum(x - first[over], y - first[under]) + 1
            rise = climbs & same & (over >= 0) & edge & (name[over] == name[under])
            stride = np.where(same & ~rise, np.where(block[x], left, 1), 0) * step
            ended = ~same & (x < self.words)
            if ended.any():
                out[place[ended]] = np.abs(x[ended] - origin[ended])
                keep = ~ended
                place, origin, x, y, climbs = place[keep], origin[keep], x[keep], y[keep], climbs[keep]
                same, rise, stride, over, under = same[keep], rise[keep], stride[keep], over[keep], under[keep]
            low_x, low_y = (first[x], first[y]) if step > 0 else (first[x + 1] - 1, first[y + 1] - 1)
            x = np.where(rise, over, np.where(same, x + stride, low_x))
            y = np.where(rise, under, np.where(same, y + stride, low_y))
            climbs &= same
        return out


def harmonic(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all candidates of texts of these lengths, about ``GRID`` at once."""
    periods = np.where(lengths >= LEAST, lengths // TIMES, 0)
    if not periods.sum():
        return
    text = np.repeat(np.arange(len(lengths)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    apart = np.maximum((TIMES - 1) * period, LEAST - period)
    count = -((period - lengths[text]) // apart)
    ends, low = np.cumsum(count), 0
    while low < len(text):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + GRID, "right")))
        many = count[low:high]
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        part = np.repeat(np.arange(low, high), many)
        yield text[part], nth * apart[part], period[part]
        low = high


def runs_of(word: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, sorted. ``word`` numbers the words of texts
    that lie one after another, text t from ``offsets[t]`` on."""
    lengths = np.diff(offsets)
    marks = int(word.max()) + 1 if len(word) else 0
    cut = np.full(len(word) + len(lengths) + 1, -1, np.int64)
    at = offsets + np.arange(len(offsets))  # places of the marks
    cut[at] = marks + np.arange(len(at))
    cut[cut < 0] = word
    grammar, found = None, []
    for text, place, period in harmonic(lengths):
        a = at[text] + 1 + place
        alike = cut[a] == cut[a + period]
        if not alike.any():
            continue
        grammar = grammar or Grammar(cut, marks)
        text, a, period = text[alike], a[alike], period[alike]
        ahead = grammar.extend(a, a + period, 1)
        back = grammar.extend(a - 1, a + period - 1, -1)
        length = ahead + back + period
        long = length >= np.maximum(LEAST, TIMES * period)
        found.append(np.stack([text, a - back - at[text] - 1, length, period])[:, long])
    if not found:
        return np.zeros((0, 4), np.int64)
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, text))
    rows = np.stack([text, start, length, period], axis=1)[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _block(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each row."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, parent = pc.list_flatten(split), pc.list_parent_indices(split)
    full = pc.not_equal(flat, "")
    words, parent = flat.filter(full), parent.filter(full).to_numpy(zero_copy_only=False)
    offsets = np.searchsorted(parent, np.arange(len(texts) + 1))
    runs = runs_of(words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets)
    text, start, length, period = runs.T
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, offsets[text] + start + period, 1)
    np.add.at(covered, offsets[text] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(kept, offsets), pa.int32()), words.take(pa.array(kept)))
    structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    found = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), structs)
    return found, pc.binary_join(lists, " ")


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``runs``, all runs by start and period, and ``collapsed``: the text's words but
    for those that a run holds after its first period, joined by one space."""
    ship(docs.sparkSession)
    docs = docs.drop("runs", "collapsed")
    name = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = texts_of(batch.column(name))
            for low, high in blocks(offsets):
                rows = batch.slice(low, high - low)
                made = _block(rows.column(name).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*rows.columns, *made], [*batch.schema.names, "runs", "collapsed"])

    more = [T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    return in_arrow(docs, run, T.StructType([*docs.schema.fields, *more]))
