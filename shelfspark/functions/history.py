"""NumPy kernels of one series: its empty days, and what its earlier rows say (lags, rolling moments and sums). Free of
Spark imports, because the functions run inside Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def readings(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray | None]:
    """Values as doubles, 0 where unknown, and 1 where known, else 0; no such vector if all are known."""
    values = column.combine_chunks().cast(pa.float64())
    if not values.null_count:
        return values.to_numpy(), None
    return values.fill_null(0.0).to_numpy(), values.is_valid().cast(pa.int8()).to_numpy().astype(float)


def rolling_sums(values: np.ndarray, windows: Sequence[int]) -> dict[int, np.ndarray]:
    """Sum of the previous rows for each window, the current row excluded. Nothing is subtracted, so nothing cancels."""
    n, total, out = len(values), np.zeros(len(values)), {}
    for k in range(1, max(windows) + 1):
        total[k:] += values[: max(n - k, 0)]
        if k in windows:
            out[k] = total.copy()
    return out


def rolling_numbers(known: np.ndarray | None, n: int, windows: Sequence[int]) -> dict[int, np.ndarray]:
    """How many of the previous rows are known."""
    return {w: np.minimum(np.arange(n), w) for w in windows} if known is None else rolling_sums(known, windows)


def rolling_moments(values: np.ndarray, known: np.ndarray | None, windows: Sequence[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per window the number of known values of the previous rows, their mean (0 without any) and the sum of their squared
    deviations from it."""
    n, out = len(values), {}
    numbers, sums = rolling_numbers(known, n, windows), rolling_sums(values, windows)
    room = np.empty(n)
    for w in windows:
        mean = sums[w] / np.maximum(numbers[w], 1)
        squares = np.zeros(n)
        for k in range(1, min(w, n - 1) + 1):
            apart = room[: n - k]
            np.subtract(values[: n - k], mean[k:], out=apart)
            apart *= apart
            if known is not None:
                apart *= known[: n - k]
            squares[k:] += apart
        out[w] = numbers[w], mean, squares
    return out


@dataclass(frozen=True)
class Wanted:
    """Columns to make: ``lags`` by name (target, rows), ``rolling`` by name (target, "mean" or "std", rows) and the ``share``
    (name, part, whole, rows) of two sums, within 0 and 1."""

    lags: dict[str, tuple[str, int]] = field(default_factory=dict)
    rolling: dict[str, tuple[str, str, int]] = field(default_factory=dict)
    share: tuple[str, str, str, int] | None = None

    @property
    def names(self) -> list[str]:
        return [*self.lags, *self.rolling, *(self.share or ())[:1]]

    @property
    def sources(self) -> set[str]:
        """Columns that the wanted ones are made of."""
        return {t for t, _ in self.lags.values()} | {t for t, _, _ in self.rolling.values()} | {*(self.share or ())[1:3]}


def _doubles(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values, mask=~known)


def in_order(rows: pa.Table, day: str) -> pa.Table:
    """Rows by day, unknown days first; as they are if they lie so."""
    days = rows.column(day).combine_chunks()
    if days.null_count == 0 and (np.diff(days.cast(pa.int32()).to_numpy()) >= 0).all():
        return rows
    return rows.take(pc.sort_indices(days, null_placement="at_start"))


def with_history(rows: pa.Table, wanted: Wanted) -> pa.Table:
    """The rows of one series, in the order of days, with the wanted columns after them."""
    n, made = rows.num_rows, {}
    for name, (target, k) in wanted.lags.items():
        column = rows.column(target).combine_chunks()
        made[name] = pa.concat_arrays([pa.nulls(min(k, n), column.type), column[: max(n - k, 0)]])
    with np.errstate(all="ignore"):
        for target in dict.fromkeys(t for t, _, _ in wanted.rolling.values()):
            own = {name: (kind, w) for name, (t, kind, w) in wanted.rolling.items() if t == target}
            moments = rolling_moments(*readings(rows.column(target)), sorted({w for _, w in own.values()}))
            for name, (kind, w) in own.items():
                number, mean, squares = moments[w]
                made[name] = _doubles(mean, number > 0) if kind == "mean" else _doubles(np.sqrt(squares / np.maximum(number - 1, 1)), number > 1)
        if wanted.share:
            name, *both, w = wanted.share
            (part, some), (whole, other) = (
                (rolling_sums(values, [w])[w], rolling_numbers(known, n, [w])[w]) for values, known in (readings(rows.column(c)) for c in both)
            )
            ratio = part / (whole + 1e-5)
            # SQL has a ratio that is no number above all others.
            made[name] = _doubles(np.where(np.isnan(ratio), 1.0, np.clip(ratio, 0.0, 1.0)), (some > 0) & (other > 0))
    return pa.Table.from_arrays([*rows.columns, *(made[name] for name in wanted.names)], names=[*rows.column_names, *wanted.names])


@dataclass(frozen=True)
class Cells:
    """How a series unfolds: its columns, those of which an unknown value is 0, the one whose absence makes an outage, and
    those that nobody needs."""

    day: str
    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    measures: tuple[str, ...]
    zeros: tuple[str, ...]
    flag: str
    flagged: str
    dropped: tuple[str, ...] = ()


def unfolded(rows: pa.Table, how: Cells) -> pa.Table:
    """The cells of one series from its facts and its opening row (``_fact`` 0), which carries the attributes and all ``_days``.

    Each row unfolds the empty days up to the next one; several facts on one day all stay. No cell without an opening row.
    """
    dates, fact = rows.column(how.day).cast(pa.int32()).to_numpy(), rows.column("_fact").to_numpy()
    order = np.lexsort((fact, dates))
    dates, fact = dates[order], fact[order]
    head = rows.slice(int(order[0]), 1)
    if fact[0] == 0:
        days = head.column("_days").combine_chunks().values.cast(pa.int32()).to_numpy()
        lengths = np.maximum(np.append(dates[1:], days[-1] + 1) - dates, fact)
        row = np.repeat(np.arange(len(dates)), lengths)
        place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        cell = dates[row] + place
        if days[-1] - days[0] >= len(days):
            kept = np.isin(cell, days)
            row, place, cell = row[kept], place[kept], cell[kept]
    else:
        row = place = cell = np.zeros(0, np.int32)
    n = len(cell)
    picked = pa.array(order[row], mask=~((place == 0) & (fact[row] == 1)))
    out = {how.day: pa.array(cell.astype(np.int32)).cast(pa.date32())}
    out |= {c: pa.repeat(head.column(c)[0], n) for c in (*how.keys, *how.attributes) if c not in how.dropped}
    out |= {c: rows.column(c).combine_chunks().take(picked) for c in how.measures if c not in how.dropped}
    if how.flag not in how.dropped:
        flag = rows.column(how.flagged).combine_chunks().take(picked).is_null()
        out[how.flag] = flag.cast(pa.int32())
    for c in how.zeros:
        if c in how.dropped:
            continue
        own = out[c]
        if pa.types.is_floating(own.type):
            own = pc.if_else(pc.is_nan(own), pa.scalar(None, own.type), own)
        out[c] = own.fill_null(0)
    return pa.Table.from_pydict(out)


def vector(rows: pa.Table, how: Cells, target: str, end: int, name: str, names: list[str]) -> pa.Table:
    """One row for a series: the keys, its ``name``, the first day and one value for every day up to ``end`` (its number), each
    gap with the value before it or else the first one; no row without any value."""
    cells = unfolded(rows, how)
    days = cells.column(how.day).cast(pa.int32()).to_numpy()
    y = cells.column(target).combine_chunks().cast(pa.float64()).filter(pa.array(days <= end))
    days, known = days[days <= end], y.is_valid().to_numpy(zero_copy_only=False)
    some = known.any()
    if some and (np.diff(days) != 1).any():
        raise ValueError(f"not one reading a day: {rows.column(name)[0]}")
    latest = np.maximum.accumulate(np.where(known, np.arange(len(days)), -1))
    filled = y.to_numpy(zero_copy_only=False)[np.where(latest < 0, known.argmax(), latest)] if some else []
    out = {c: rows.column(c).slice(0, int(some)) for c in (*how.keys, name)}
    out["first_ds"] = pa.array(days[: int(some)].astype(np.int32)).cast(pa.date32())
    out["y"] = pa.array([filled] if some else [], pa.list_(pa.float64()))
    return pa.Table.from_pydict(out).select(names)
