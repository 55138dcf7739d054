"""Top-k of hopping windows by a sweep over window starts.

Seen along the window starts, the content of a window changes only where a
pane enters or leaves it: at most twice a pane.  A task holds, for one group
of items, the running totals of the items inside the window and their order;
it goes through its panes in time order and writes a row only where the k
best change.  Totals are kept as exact integers (amounts in units of 2**-80),
so that adding and taking away leaves no trace, and are rounded once when
they are shown.

Functions here run inside tasks on Arrow batches sorted by group and time;
they hold one window's content, never a whole group.
"""

from __future__ import annotations

import heapq
import sys
from bisect import bisect_left, insort
from collections import deque

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENTS = ("item_type string, blk long, salt int, seg long, seg_end long, "
            "top array<struct<item_name:string,count:long,price:double,amount:double>>")
_UNIT = 1 << 80
_PLAIN, _INFINITE = 2.0 ** -27, float("inf")    # from here on a double is a whole number of units
_ROWS = 5_000   # segments written at a time


def _exact(amount: float | None) -> int | None:
    """An amount in whole units; unknown and non-finite ones count as null."""
    if amount is None or amount - amount != 0:
        return None
    n, d = amount.as_integer_ratio()
    return n * _UNIT // d


def _values(column: pa.Array) -> list:
    """A column's values; without nulls by way of numpy, several times as fast."""
    return column.to_pylist() if column.null_count else column.to_numpy(zero_copy_only=False).tolist()


class _Segments:
    """Rows of consecutive segments; equal neighbours become one."""

    def __init__(self):
        self.rows: list = []

    def add(self, group, start: int, end: int, top: list) -> None:
        if not top or start >= end:
            return
        last = self.rows[-1] if self.rows else None
        if last and last[2] == start and (last[3] is top or last[3] == top) and last[0] == group:
            last[2] = end
        else:
            self.rows.append([group, start, end, top])

    def take(self, least: int) -> list[pa.RecordBatch]:
        """All rows but the last as a batch, if there are ``least``; all for 0."""
        n = len(self.rows) - (1 if least else 0)
        if n < max(least, 1):
            return []
        rows, self.rows = self.rows[:n], self.rows[n:]
        flat = [x for r in rows for x in r[3]]
        at = [0]
        for r in rows:
            at.append(at[-1] + len(r[3]))
        cells = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.string(), pa.int64(), pa.float64(), pa.float64()))],
                                           names=["item_name", "count", "price", "amount"])
        columns = [pa.array([r[0][i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32()))]
        columns += [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2)]
        return [pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(at, pa.int32()), cells)],
                                           names=["item_type", "blk", "salt", "seg", "seg_end", "top"])]


class _Window:
    """The items inside the window, ordered by (amount, name).  ``changed``
    tells whether the ``k`` best may differ from those last taken."""

    def __init__(self, k: int):
        self.k = k
        self.items: dict = {}       # name -> [key, count, panes (count, amount, price), amount in units, known amounts]
        self.order: list = []       # keys: (no amount, -amount, name)
        self.changed = True
        self.best: list = []

    def _out(self, key) -> None:
        at = bisect_left(self.order, key)
        del self.order[at]
        if at < self.k:
            self.changed = True

    def _in(self, key) -> None:
        at = bisect_left(self.order, key)
        self.order.insert(at, key)
        if at < self.k:
            self.changed = True

    def enter(self, name: str, count: int | None, amount: float | None, price: float | None) -> None:
        item = self.items.get(name)
        if item is None:
            # of one pane, as most are: the amount stands for itself, unless
            # it is unknown or has parts below a unit
            plain = amount is not None and (_PLAIN <= amount < _INFINITE or amount == 0)
            exact = None if plain else _exact(amount)
            key = (0, -(amount + 0.0 if plain else exact / _UNIT), name) if plain or exact is not None else (1, 0.0, name)
            self.items[name] = [key, count or 0, deque([(count or 0, amount if plain else exact, price)]), None, 0]
            self._in(key)
            return
        if item[3] is None:         # a second pane: sums from now on
            item[3], item[4] = self._units(item[2][0][1])
        exact = _exact(amount)
        item[1] += count or 0
        if exact is not None:
            item[3] += exact
            item[4] += 1
        item[2].append((count or 0, exact, price))
        self._again(name, item)

    @staticmethod
    def _units(amount) -> tuple[int, int]:
        if amount is None:
            return 0, 0
        return (_exact(amount) if isinstance(amount, float) else amount), 1

    def _again(self, name, item) -> None:
        self._out(item[0])
        item[0] = (0, -(item[3] / _UNIT), name) if item[4] else (1, 0.0, name)
        self._in(item[0])

    def leave(self, name: str) -> None:
        """The item's earliest pane goes."""
        item = self.items[name]
        count, amount, _ = item[2].popleft()
        if not item[2]:
            del self.items[name]
            self._out(item[0])
            return
        exact, known = self._units(amount)
        item[1] -= count
        item[3] -= exact
        item[4] -= known
        self._again(name, item)

    def top(self) -> list:
        if self.changed:
            self.best = []
            for unknown, amount, name in self.order[:self.k]:
                item = self.items[name]
                self.best.append((name, item[1], item[2][0][2], None if unknown else -amount))
            self.changed = False
        return self.best


def _rank_panes(k: int):
    def run(batches):
        out, group, window, leaving, now = _Segments(), None, None, None, 0

        def upto(point):
            """Emit what lies before ``point`` (None: the end of the group)."""
            nonlocal now
            while leaving and (point is None or leaving[0][0] <= point):
                end = leaving[0][0]
                out.add(group, now, end, window.top())
                now = end
                while leaving and leaving[0][0] == end:
                    window.leave(leaving.popleft()[1])
            if point is not None and point > now:
                out.add(group, now, point, window.top())
                now = point

        for batch in batches:
            for kind, blk, salt, first, behind, name, count, amount, price in zip(*map(_values, batch.columns)):
                if group != (kind, blk, salt):
                    if group:
                        upto(None)
                    group, window, leaving, now = (kind, blk, salt), _Window(k), deque(), first
                upto(first)
                window.enter(name, count, amount, price)
                leaving.append((behind, name))
            yield from out.take(_ROWS)
        if group:
            upto(None)
        yield from out.take(0)

    return run


def _merge_salts(k: int):
    def place(x):
        return (x[3] is None, 0.0 if x[3] is None else -x[3], x[0])

    def run(batches):
        out, group, held, ends, now = _Segments(), None, None, None, 0

        def upto(point):
            nonlocal now
            while ends and (point is None or ends[0][0] <= point):
                end = ends[0][0]
                out.add(group, now, end, sorted((x for top in held.values() for x in top), key=place)[:k])
                now = end
                while ends and ends[0][0] == end:
                    del held[heapq.heappop(ends)[1]]
            if point is not None and point > now:
                out.add(group, now, point, sorted((x for top in held.values() for x in top), key=place)[:k])
                now = point

        for batch in batches:
            for kind, blk, salt, seg, seg_end, top in zip(*(c.to_pylist() for c in batch.columns)):
                if group != (kind, blk, 0):
                    if group:
                        upto(None)
                    group, held, ends, now = (kind, blk, 0), {}, [], seg
                upto(seg)
                held[salt] = [(x["item_name"], x["count"], x["price"], x["amount"]) for x in top]
                heapq.heappush(ends, (seg_end, salt))
            yield from out.take(_ROWS)
        if group:
            upto(None)
        yield from out.take(0)

    return run


def rank_panes(spread: DataFrame, k: int) -> DataFrame:
    """Ranked segments (SEGMENTS) of every (item_type, blk, salt) of
    ``spread``: one row per pane and block, ``a`` the first window start that
    holds it, ``b1`` the one behind the last."""
    group = ["item_type", "blk", "salt"]
    return (spread.select(*group, "a", "b1", "item_name", "cnt", "amt", "first_price", "pane")
            .repartition(*group).sortWithinPartitions(*group, "a", "pane")
            .drop("pane").mapInArrow(_rank_panes(k), SEGMENTS))


def merge_salts(segments: DataFrame, k: int) -> DataFrame:
    """Ranked segments of every (item_type, blk), from those of its salts:
    an item's totals live in one salt, so the k best of all are among the k
    best of each."""
    return (segments.repartition("item_type", "blk").sortWithinPartitions("item_type", "blk", "seg")
            .mapInArrow(_merge_salts(k), SEGMENTS))


def flat(segments: DataFrame) -> DataFrame:
    """One row per segment and rank, from 1."""
    return (segments.select("item_type", "blk", "seg", "seg_end", F.posexplode("top").alias("rank", "t"))
            .select("item_type", "blk", "seg", "seg_end", "t.*", (F.col("rank") + 1).cast("int").alias("rank")))
