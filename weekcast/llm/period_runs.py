"""Runs of periodic repetition by internal pattern matching.

A run is a stretch of words with smallest period q and at least ``max(min_length, 2 q)`` words that no neighbouring
word extends keeping that period.  All runs of whole texts are found, exactly:

1. The texts of a block are one sequence of words, each word marked with its text, so that nothing matches across
   texts.  Prefix doubling names the stretches of 1, 2, 4, ... words; the last names are the suffix array, and a
   stretch of 2^k words is an interval of it.  Names also give the longest common extension of two places, forwards
   and backwards, in one comparison a level.
2. A run of period p has a dyadic block (2^k words, starting at a multiple of 2^k) whose copy p words on lies in the run too, where 2^k
   is at most half of what the run's length leaves beside p.  So each period belongs to one level, and each
   dyadic block asks for its occurrences in the neighbouring window that the level's periods span: a range successor
   query in a wavelet matrix over the suffix array, for all blocks of a level at once.
3. Occurrences that follow each other within half a block form an arithmetic progression: block and progression each lie in one run
   of that difference.  Such a progression is not walked through; its candidate periods follow from the ends of the two
   runs (where the ends correspond, or where the two runs touch and the shift stays within both).
4. Each candidate is extended to both sides; what is long enough is a run, and the smallest period wins among equal stretches.

Work is in blocks of texts inside a task, n log n for n words; nothing is shuffled, so a hot source doesn't matter.

Edge cases: a null or empty text has no words and no runs; a text below ``min_length`` words has no runs; a block has one
text at least, so a very long text is a block of its own (about 250 bytes a word are held); each row gives a row, equal
rows equal ones; columns beside id and text aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, pieces
from .registry import query


class Names:
    """Names of the stretches of 2^k words at each place: ``levels[k][i]`` is the rank of the first suffix that begins with that stretch."""

    def __init__(self, first: np.ndarray):
        n = len(first)
        order = np.argsort(first, kind="stable")
        named = np.empty(n, np.int32)
        named[order] = self._first_equal(first[order])
        self.levels = [named]
        sizes = np.bincount(self.levels[0], minlength=n)
        active, width = np.flatnonzero(sizes[self.levels[0]] > 1), 1
        while len(active):
            old = self.levels[-1]
            after = active + width
            second = np.where(after < n, old[np.minimum(after, n - 1)], -1).astype(np.int64)
            key = old[active].astype(np.int64) * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            active, key = active[order], key[order]
            new = old.copy()
            base = old[active].astype(np.int64)
            new[active] = base + self._first_equal(key) - self._first_equal(base)
            self.levels.append(new)
            sizes = np.bincount(new, minlength=n)
            active, width = np.sort(active[sizes[new[active]] > 1]), width * 2
        self.n = n

    @staticmethod
    def _first_equal(values: np.ndarray) -> np.ndarray:
        """For each of some sorted values, the place of the first equal one."""
        starts = np.arange(len(values))
        starts[1:][values[1:] == values[:-1]] = 0
        return np.maximum.accumulate(starts)

    def suffixes(self) -> np.ndarray:
        out = np.empty(self.n, np.int32)
        out[self.levels[-1]] = np.arange(self.n, dtype=np.int32)
        return out

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and j on (i < j <= n)."""
        i, j, start = i.copy(), j.copy(), j
        for k in range(len(self.levels) - 2, -1, -1):
            names, width = self.levels[k], 1 << k
            same = (j + width <= self.n) & (names[np.minimum(i, self.n - 1)] == names[np.minimum(j, self.n - 1)])
            i += same * width
            j += same * width
        return j - start

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree before i and j (0 <= i < j)."""
        i, j, start = i.copy(), j.copy(), j
        for k in range(len(self.levels) - 2, -1, -1):
            names, width = self.levels[k], 1 << k
            same = (i >= width) & (names[np.maximum(i - width, 0)] == names[np.maximum(j - width, 0)])
            i -= same * width
            j -= same * width
        return start - j


#: Beyond any place.
NONE = 1 << 40


class WaveletMatrix:
    """Range successor queries over a permutation of 0 ... n - 1."""

    def __init__(self, values: np.ndarray):
        self.n, self.bits = len(values), max(1, int(len(values) - 1).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def successor(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``least`` in each range [left, right) of places; NONE where there is none."""
        out = np.full(len(left), NONE, np.int64)
        asked = np.flatnonzero((least < self.n) & (left < right))
        if not len(asked):
            return out
        lo, hi, x = left[asked].astype(np.int64), right[asked].astype(np.int64), least[asked]
        smaller = np.zeros(len(asked), np.int64)
        for level, before in enumerate(self.zeros):  # how many are smaller
            a, b = before[lo], before[hi]
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            smaller += np.where(one, b - a, 0)
            lo, hi = np.where(one, before[-1] + lo - a, a), np.where(one, before[-1] + hi - b, b)
        found = smaller < (right - left)[asked]
        asked, rank = asked[found], smaller[found]
        lo, hi, value = left[asked].astype(np.int64), right[asked].astype(np.int64), np.zeros(len(asked), np.int64)
        for before in self.zeros:  # the one with that rank
            a, b = before[lo], before[hi]
            one = rank >= b - a
            rank = rank - np.where(one, b - a, 0)
            lo, hi = np.where(one, before[-1] + lo - a, a), np.where(one, before[-1] + hi - b, b)
            value = value * 2 + one
        out[asked] = value
        return out


def windows(longest: int, min_length: int) -> list[tuple[int, int, int]]:
    """(k, lowest, highest period) of the blocks of 2^k words, for periods up to half of ``longest``."""
    periods = np.arange(1, longest // 2 + 1)
    room = (np.maximum(2 * periods, min_length) - periods + 1) // 2
    levels = np.frexp(room)[1] - 1  # floor of the binary logarithm
    return [(int(k), int(p[0]), int(p[-1])) for k in np.unique(levels) for p in [periods[levels == k]]]


def _progressions(names: Names, s, o, step, lo, hi):
    """Candidates (block, period) of the progressions that start at o with that step, and the end of each progression's run."""
    end_1, end_2 = (x + step + names.forward(x, x + step) for x in (s, o))
    start_1, start_2 = (x - names.backward(x, x + step) for x in (s, o))
    apart = (start_1 != start_2) | (end_1 != end_2)
    blocks, periods = [s, s], [end_2 - end_1, start_2 - start_1]
    # where the two runs touch, every period of the progression that stays within both gives a run of its own
    most = np.minimum.reduce([end_1 - start_1, (end_2 - start_1) // 2, end_2 - start_2, np.full(len(s), hi)])
    count = np.where(apart & (end_1 >= start_2), np.maximum((most - (o - s)) // step + 1, 0), 0)
    if count.any():
        t = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        blocks.append(np.repeat(s, count))
        periods.append(np.repeat(o - s, count) + t * np.repeat(step, count))
    return np.concatenate(blocks), np.concatenate(periods), end_2


def find_runs(first: np.ndarray, longest: int, min_length: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, smallest period) of all runs in a sequence of codes, ordered by start and period.

    ``longest``: no repetition is longer than that (the longest text of the block)."""
    empty = (np.zeros(0, np.int64),) * 3
    if longest < max(min_length, 2):
        return empty
    names = Names(first)
    matrix, found = None, []
    for k, lo, hi in windows(longest, min_length):
        if k >= len(names.levels) - 1:  # no stretch of this length occurs twice
            break
        level, width = names.levels[k], 1 << k
        s = np.arange(0, names.n - width + 1, width)
        sizes = np.bincount(level, minlength=names.n)
        s = s[sizes[level[s]] > 1]
        if not len(s):
            continue
        if matrix is None:
            matrix = WaveletMatrix(names.suffixes())
        left = level[s].astype(np.int64)
        right = left + sizes[left]
        o = matrix.successor(left, right, s + lo)
        while True:
            on = o <= s + hi
            s, left, right, o = s[on], left[on], right[on], o[on]
            if not len(s):
                break
            found.append((s, o - s))
            after = matrix.successor(left, right, o + 1)
            step = after - o
            many = (step <= width // 2) & (after <= s + hi)
            if many.any():
                found.append((s[many], after[many] - s[many]))
                blocks, periods, end = _progressions(names, s[many], o[many], step[many], lo, hi)
                inside = (periods >= lo) & (periods <= hi)
                found.append((blocks[inside], periods[inside]))
                last = o[many] + (end - width - o[many]) // step[many] * step[many]
                after[many] = matrix.successor(left[many], right[many], last + 1)
            o = after
    if not found:
        return empty
    s, p = (np.concatenate(x) for x in zip(*found, strict=True))
    s, p = np.divmod(np.unique(s * (names.n + 1) + p), names.n + 1)
    keep = s + p < names.n
    s, p = s[keep], p[keep]
    start, end = s - names.backward(s, s + p), s + p + names.forward(s, s + p)
    keep = end - start >= np.maximum(min_length, 2 * p)
    start, end, p = start[keep], end[keep], p[keep]
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, p = start[keep], end[keep], p[keep]
    order = np.lexsort((p, start))
    return start[order], (end - start)[order], p[order]


def text_runs(texts: list[list[bytes]], min_length: int = 12) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of each of some texts, given as lists of words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    codes = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    first = codes.indices.to_numpy().astype(np.int64) + np.repeat(np.arange(len(texts)), sizes) * max(1, len(codes.dictionary))
    start, length, period = find_runs(first, int(sizes.max(initial=0)), min_length)
    text = np.searchsorted(starts, start, side="right") - 1  # of texts with one start, only the last has words
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(start[a:b] - starts[i], length[a:b], period[a:b]) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]


def repeated(words: list[bytes], row_id) -> list[bytes]:
    """The words with the repetition that the query's contract lays into a tenth of the documents."""
    n = len(words)
    h = zlib.crc32(str(row_id).encode()) if row_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def collapsed(words: list[bytes], runs) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not len(runs[0]):
        return words
    start, length, period = runs
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, start + period, 1)
    np.add.at(mark, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0).tolist()]


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
          "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def detect_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12, change=None, outputs: bool = True,
                block_bytes: int = 1 << 19) -> DataFrame:
    """Per row: the id; n_runs; start, length, period and exponent_milli of its longest run (nulls if none); digests of all
    runs and of the collapsed text; and with ``outputs`` the runs and the collapsed text (words joined by one space).
    ``change`` may put other words in place of a text's words (words, id)."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    fields = T.StructType.fromDDL(SCHEMA).fields
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), *(fields if outputs else fields[:7])])
    arrow = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string()]

    def one(words, runs):
        start, length, period = (x.tolist() for x in runs)
        said = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start, length, period, strict=True))
        kept = b" ".join(collapsed(words, runs))
        best = min(range(len(start)), key=lambda i: (-length[i], start[i], period[i]), default=None)
        top = (None,) * 4 if best is None else (start[best], length[best], period[best], 1000 * length[best] // period[best])
        row = (len(start), *top, _digest(said.encode()), _digest(kept))
        if not outputs:
            return row
        return (*row, [{"start": s, "length": n, "period": p} for s, n, p in zip(start, length, period, strict=True)], kept.decode())

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "_text", block_bytes):
                ids = piece.column("_id")
                texts = [(t or b"").split() for t in piece.column("_text").cast(pa.binary()).to_pylist()]
                if change is not None:
                    texts = [change(t, i) for t, i in zip(texts, ids.to_pylist(), strict=True)]
                made = [one(t, r) for t, r in zip(texts, text_runs(texts, min_length), strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, a) for c, a in zip(zip(*made, strict=True), arrow))], names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


@query("op13_period_runs")
def op13(spark, sf_dir):
    return detect_runs(documents(spark, sf_dir), change=repeated, outputs=False)
