"""First exits of positions over sorted Arrow batches, without a row for each pair of a position and a bar.

Rows come by series and time. Numpy looks for first hits in trees of maxima over a chunk of rows; what is not decided at the
end of a chunk (positions whose time limit lies ahead, and the bars since their entry) is carried into the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

_MOST = np.finfo(float).max
REASONS = ("stop", "trailing", "target", "time")


def _numbers(column: pa.ChunkedArray, sign: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """sign * column, and where it is not null. NaN counts as the largest number, as in SQL; nulls are below every level."""
    there = ~column.is_null().to_numpy()
    x = np.array(column.to_numpy(), dtype=float)
    near = np.nextafter(_MOST, 0)
    x = np.where(np.isnan(x), _MOST, np.clip(x, -near, near))  # infinity is below NaN
    return np.where(there, sign * x, -np.inf), there


def first_at_least(values: np.ndarray, start: np.ndarray, level: np.ndarray) -> np.ndarray:
    """For each query the least i >= start with values[i] >= level; len(values) if none. Levels are above -inf."""
    out = np.full(len(start), len(values))
    if not len(values):
        return out
    tree = [values]
    while len(tree[-1]) > 1:
        if len(tree[-1]) % 2:
            tree[-1] = np.append(tree[-1], -np.inf)
        tree.append(np.maximum(tree[-1][::2], tree[-1][1::2]))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    who = np.flatnonzero(start < len(values))
    node = start[who]
    for v in tree:  # up: a left child is left to its parent
        look = node < len(v)
        if len(v) > 1:
            look &= node % 2 == 1
        hit = np.zeros(len(node), dtype=bool)
        hit[look] = v[node[look]] >= level[who[look]]
        found.append((who[hit], node[hit]))
        who, node = who[~hit], (node[~hit] + 1) // 2
    who, node = found[-1]
    for v, (more, at) in zip(tree[-2::-1], found[-2::-1], strict=True):  # down, to the left where it reaches the level
        node = 2 * node
        node = node + (v[node] < level[who])
        who, node = np.append(who, more), np.append(node, at)
    out[who] = node
    return out


def _solved(rows: pa.Table, whole: bool, keep: Sequence[str]) -> tuple[pa.Table, pa.Table]:
    """Exits of the positions that are decided, and the rows to carry. whole: the last series ends with these rows."""
    n = rows.num_rows
    flag = lambda c: np.array(rows[c].to_numpy(), dtype=bool)
    bar, pos = flag("__bar"), flag("__pos")
    first = rows["__n"].to_numpy() == 1
    first[0] = True
    sid = np.cumsum(first) - 1
    seen = np.cumsum(bar)
    at_bar, at_pos = np.flatnonzero(bar), np.flatnonzero(pos)
    n_bars = none = len(at_bar)
    last_row = np.append(np.flatnonzero(first)[1:], n) - 1
    end = seen[last_row]
    begin = np.append(0, end[:-1])
    of_bar, of_pos = sid[at_bar], sid[at_pos]
    stop_at = end[of_pos]
    limits = rows["__limit"].take(pa.array(at_pos))
    known = ~limits.is_null().to_numpy()
    start = np.where(known, seen[at_pos], n_bars)

    bars, own = rows.take(pa.array(at_bar)), rows.take(pa.array(at_pos))
    t = bars["__t"].to_numpy().astype(np.int64)
    limit = np.array(limits.fill_null(0).to_numpy(), dtype=np.int64)
    times = np.unique(t)
    width = len(times) + 1
    late = np.searchsorted(of_bar * width + np.searchsorted(times, t), of_pos * width + np.searchsorted(times, limit))
    late = np.where(known, np.maximum(late, start), none)

    high, _ = _numbers(bars["high"])
    down, _ = _numbers(bars["low"], -1.0)
    c, c_there = _numbers(bars["__c"])
    c_down, _ = _numbers(bars["__c"], -1.0)

    def search(values: np.ndarray, name: str, sign: float) -> np.ndarray:
        level, there = _numbers(own[name], sign)
        return first_at_least(values, np.where(there, start, n_bars), level)

    # the last bar before i with a high of at least c(i): bar i stops all positions entered before it
    back = n_bars - 1 - first_at_least(high[::-1], np.where(c_there, n_bars - np.arange(n_bars), n_bars), c)
    stops = np.flatnonzero(back >= begin[of_bar])
    least = np.full(n_bars + 1, none)
    least[back[stops][::-1]] = stops[::-1]  # of several the first
    least = np.minimum.accumulate(least[::-1])[::-1]
    hits = np.stack([search(down, "stop", -1.0), np.minimum(search(c_down, "entry", -1.0), least[start]), search(high, "target", 1.0), late])
    hits = np.where(hits < stop_at, hits, none)
    rule = hits.argmin(0)
    hit = hits.min(0)
    exits = hit < stop_at
    decided = exits | whole | (of_pos < sid[-1])
    which = np.flatnonzero(decided)
    place = pa.array(np.where(exits, hit, 0)[which], mask=~exits[which])
    reason = pa.array(np.array(REASONS, dtype=object)[rule[which]], pa.string(), mask=~exits[which])
    out = own.select(list(keep)).take(pa.array(which))
    d = bars["d"].take(place) if n_bars else pa.nulls(len(which), rows["d"].type)
    out = out.append_column("exit_date", d).append_column("reason", reason)
    left = at_pos[~decided]
    carry = rows.slice(left[0]) if len(left) else rows.slice(n)
    if len(left):
        mine = np.zeros(n, dtype=bool)
        mine[left] = True
        carry = carry.set_column(rows.schema.get_field_index("__pos"), "__pos", pa.array(mine[left[0] :]))
    return out, carry


def walker(keep: Sequence[str], chunk: int = 1 << 17) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow: exits of the positions of a partition's rows, which are sorted by series and time.

    Rows: __n (number in the series from 1), __t, __bar, __pos (whether the row is a bar, a position, or both), for bars d, high,
    low and __c (a trailing stop is hit at this level), for positions entry, stop, target, __limit and keep. Bars come before
    positions of their time. At least as many new rows as carried ones are read at once, so that each row is looked at a
    small number of times; memory holds the rows of one time limit.
    """

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, new, n = None, [], 0
        for b in batches:
            new.append(b)
            n += b.num_rows
            if n >= max(chunk, carry.num_rows if carry else 0):
                out, carry = _solved(_joined(carry, new), False, keep)
                new, n = [], 0
                yield from out.to_batches()
        if n or (carry and carry.num_rows):
            out, _ = _solved(_joined(carry, new), True, keep)
            yield from out.to_batches()

    return walk


def _joined(carry: pa.Table | None, new: list[pa.RecordBatch]) -> pa.Table:
    parts = ([carry] if carry is not None and carry.num_rows else []) + ([pa.Table.from_batches(new)] if new else [])
    return pa.concat_tables([p.cast(parts[-1].schema) for p in parts]).combine_chunks()
