"""Burrows-Wheeler transform and common prefixes of a collection, column by column.

Round j inserts, for every string at once, its suffix of length j: the symbol in
front of the suffix inserted before. The transform (the symbol in front of each
sorted suffix) tells where: symbol c at row r is the rank-th c, so the suffix it
starts is the rank-th of those that begin with c. The common prefix of a new row
with its neighbour is one more than the smallest common prefix between the rows
they were extended from.

Transform and prefix array are two sequential files. A round reads both from front
to end and writes the new ones over them. Collections are bounded (see
:mod:`suffix_dedup`), so the files are byte streams in memory and a round holds them
whole: nothing is written to a machine's own disk.
"""

from __future__ import annotations

from io import BytesIO

import numpy as np


def _load(file, n: int, kind) -> np.ndarray:
    out = np.empty(n, kind)
    file.seek(0)
    file.readinto(out)
    return out


def _store(file, values: np.ndarray) -> None:
    file.seek(0)
    file.write(values)


def _range_minima(values: np.ndarray) -> np.ndarray:
    """Row k has the minima of all runs of 2**k values."""
    n = len(values)
    out = np.empty((max(1, n.bit_length()), n), values.dtype)
    out[0] = values
    for k in range(1, len(out)):
        h = 1 << (k - 1)
        out[k] = out[k - 1]
        np.minimum(out[k - 1][: n - h], out[k - 1][h:], out=out[k][: n - h])
    return out


def _minima(table: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    k = np.frexp(last - first + 1)[1] - 1
    return np.minimum(table[k, first], table[k, last - (1 << k) + 1])


def _sorted_rows(bwt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(bwt, kind="stable")
    place = np.empty(len(bwt), np.int64)
    place[order] = np.arange(len(bwt))
    return order, place


def shared_prefixes(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, group) of every suffix of at least ``least`` bytes: two
    have the same group if and only if their first ``least`` bytes are equal."""
    m = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    longest = int(sizes.max(initial=0))
    kind = np.uint8 if longest < 255 else np.uint32
    # symbols from the end, numbered in byte order; 0 is the end of a string
    used = np.unique(np.frombuffer(b"".join(strings), np.uint8))
    symbol = np.uint8 if len(used) < 256 else np.uint16
    number = np.zeros(256, symbol)
    number[used] = np.arange(1, len(used) + 1)
    columns = np.zeros((m, longest + 1), symbol)
    for i, s in enumerate(strings):
        columns[i, : len(s)] = number[np.frombuffer(s, np.uint8)[::-1]]
    columns = np.ascontiguousarray(columns.T)
    with BytesIO() as bwt_file, BytesIO() as lcp_file:
        _store(bwt_file, columns[0])
        _store(lcp_file, np.zeros(m, kind))
        n, row = m, np.arange(m)
        for j in range(1, longest + 1):
            bwt, lcp = _load(bwt_file, n, symbol), _load(lcp_file, n, kind)
            ended = int(np.count_nonzero(bwt == 0))
            order, place = _sorted_rows(bwt)
            table = _range_minima(lcp)
            live = np.flatnonzero(sizes >= j)
            r = row[live]
            at = place[r]
            new = m + at - ended
            before, after = order[np.maximum(at - 1, 0)], order[np.minimum(at + 1, n - 1)]
            has_before = (at > 0) & (bwt[before] == bwt[r])
            has_after = (at + 1 < n) & (bwt[after] == bwt[r])
            up, down = np.zeros(len(r), kind), np.zeros(len(r), kind)
            up[has_before] = _minima(table, before[has_before] + 1, r[has_before]) + 1
            down[has_after] = _minima(table, r[has_after] + 1, after[has_after]) + 1
            old = np.ones(n + len(r), bool)
            old[new] = False
            next_bwt, next_lcp = np.empty(len(old), symbol), np.empty(len(old), kind)
            next_bwt[old], next_lcp[old] = bwt, lcp
            next_bwt[new] = columns[j, live]
            next_lcp[new] = up
            inner = new + 1 < len(old)
            next_lcp[new[inner] + 1] = down[inner]
            _store(bwt_file, next_bwt)
            _store(lcp_file, next_lcp)
            n, row[live] = len(old), new
        bwt, lcp = _load(bwt_file, n, symbol), _load(lcp_file, n, kind)
    group = np.cumsum(lcp < least)
    # the row of each suffix: from the ends of the strings, step by step
    _, place = _sorted_rows(bwt)
    row, found = np.arange(m), []
    for j in range(1, longest + 1):
        live = np.flatnonzero(sizes >= j)
        row[live] = place[row[live]] + m - int(np.count_nonzero(bwt == 0))
        if j >= least:
            found.append((live, sizes[live] - j, group[row[live]]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
