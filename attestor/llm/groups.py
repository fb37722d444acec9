"""Whole groups of rows from Arrow batches that are sorted by their first column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], piece: int = 0, again: int = 0) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The columns and where each group begins (and the last ends); many groups come at once.

    Only groups of two rows and more are given.  With ``piece``, a group of more rows than that comes in
    pieces that all begin with its first ``again`` rows.
    """
    held: list[list[np.ndarray]] = []

    def whole() -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*held, strict=True)]

    def several(cols: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        v = cols[0]
        cut = np.concatenate([[0], np.flatnonzero(v[1:] != v[:-1]) + 1])
        size = np.diff(np.append(cut, len(v)))
        keep = np.repeat(size > 1, size)
        size = size[size > 1]
        return [c[keep] for c in cols], np.concatenate([[0], np.cumsum(size)])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last group may go on in the next batch
        if last or held and held[0][0][-1] != cols[0][0]:
            held.append([c[:last] for c in cols])
            yield several(whole())
            held = []
        held.append([c[last:] for c in cols])
        if piece and sum(len(x[0]) for x in held) > piece:
            long = whole()
            yield long, np.array([0, len(long[0])])
            held = [[c[:again] for c in long]]
    if held:
        yield several(whole())
