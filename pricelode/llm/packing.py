"""Filling containers of fixed capacity with items of varying size, by swap-based local search."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import partial, reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelode.session import checkpointed

#: Items that one task packs together.
GROUP = 20_000
#: Containers filled to this share are closed when a round ends; the others' items are packed again, across tasks.
CLOSED = 0.995


class _Takers:
    """Open bins by the sizes they hold: which of them can exchange with a giver is told without visiting them.

    A bin with room r that gives back a size t (0: a move) can take a sum s with t < s <= t + r. Of the bins that hold t only
    the roomiest matters, so the largest t + r over all t < s says whether a taker of s exists.
    """

    def __init__(self, capacity: int, items: list[list[tuple[int, int]]], fill: list[int], bins: list[int]) -> None:
        self.capacity, self.items, self.fill = capacity, items, fill
        self.sizes = np.array(sorted({0} | {size for b in bins for size, _ in items[b]}))
        self.place = {size: i for i, size in enumerate(self.sizes.tolist())}
        self.rooms: list[list[tuple[int, int]]] = [[] for _ in self.place]
        self.reach = np.full(len(self.sizes), -1)
        for b in bins:
            for i in self._places(b):
                self.rooms[i].append((capacity - fill[b], b))
        for i, rooms in enumerate(self.rooms):
            rooms.sort()
            self._settle(i)

    def _places(self, b: int) -> set[int]:
        return {0} | {self.place[size] for size, _ in self.items[b]}

    def _settle(self, i: int) -> None:
        self.reach[i] = self.sizes[i] + self.rooms[i][-1][0] if self.rooms[i] else -1

    def add(self, b: int) -> None:
        for i in self._places(b):
            insort(self.rooms[i], (self.capacity - self.fill[b], b))
            self._settle(i)

    def drop(self, b: int) -> None:
        for i in self._places(b):
            self.rooms[i].pop(bisect_left(self.rooms[i], (self.capacity - self.fill[b], b)))
            self._settle(i)

    def find(self, give: list[tuple[int, int]]) -> int | None:
        """A bin that can take one or two of the giver's items, for nothing or for one smaller than they are."""
        single = np.array([size for size, _ in give])
        top = np.maximum.accumulate(self.reach)
        for made in (np.unique, _pair_sums):
            sums = made(single)
            before = np.searchsorted(self.sizes, sums) - 1
            good = np.flatnonzero(top[before] >= sums)
            if len(good):
                at = good[np.argmax(sums[good])]
                i = int(np.argmax(self.reach[:before[at] + 1] >= sums[at]))
                return self.rooms[i][-1][1]
        return None


def _pair_sums(single: np.ndarray) -> np.ndarray:
    """Sums of two different items, from distinct sizes."""
    sizes, count = np.unique(single, return_counts=True)
    a, b = np.triu_indices(len(sizes), 1)
    return np.concatenate([sizes[a] + sizes[b], 2 * sizes[count > 1]])


class Bins:
    """Bins as ordered lists of (size, item), with their fill."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []
        self.fill: list[int] = []

    def pack(self, sizes: list[int]) -> None:
        """Best fit, largest first: each item goes where it leaves the least room."""
        rooms: list[tuple[int, int]] = []  # (room, bin), in order
        for size, item in sorted(((s, i) for i, s in enumerate(sizes)), reverse=True):
            at = bisect_left(rooms, (size, -1))
            if at < len(rooms):
                room, own = rooms.pop(at)
            else:
                room, own = self.capacity, len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[own].append((size, item))
            self.fill[own] += size
            if room > size:
                insort(rooms, (room - size, own))
        for own in self.items:
            own.sort()

    def improve(self, keep: int) -> None:
        """Exchanges that raise the sum of squared fills, until `keep` bins remain or no exchange is left.

        The emptiest bin gives to underfull, fuller ones. A bin with room r takes the best of: one item of at most r (move);
        one item for a smaller one, the difference at most r (one for one); two items for one (two for one). Each makes the
        fuller bin fuller and the emptier one emptier, so the sum of squares grows and the search ends.

        Takers are found by an index over all open bins that are not emptier. A bin that no taker is left for is followed by
        the next emptiest; sweeps over all bins are repeated until one changes nothing.
        """
        left = sum(f > 0 for f in self.fill)
        changed = True
        while changed and left > keep:
            changed = False
            waiting = [(self.fill[b], b) for b in range(len(self.fill)) if 0 < self.fill[b] < self.capacity]
            heapify(waiting)
            index = _Takers(self.capacity, self.items, self.fill, [b for _, b in waiting])
            tied: set[int] = set()  # as full as the giver, and done: takers still
            level = 0
            while waiting and left > keep:
                fill, giver = heappop(waiting)
                if fill != self.fill[giver]:  # it took items since; its own entry follows
                    continue
                if fill > level:
                    for b in tied:
                        index.drop(b)
                    tied, level = set(), fill
                index.drop(giver)
                while self.items[giver]:
                    taker = index.find(self.items[giver])
                    if taker is None:
                        break
                    index.drop(taker)
                    tied.discard(taker)
                    self._best(giver, taker)
                    changed = True
                    if self.fill[taker] < self.capacity:
                        index.add(taker)
                        heappush(waiting, (self.fill[taker], taker))
                left -= not self.items[giver]
                if self.fill[giver] == fill:
                    index.add(giver)
                    tied.add(giver)

    def _best(self, giver: int, taker: int) -> bool:
        give, take = self.items[giver], self.items[taker]
        room = self.capacity - self.fill[taker]
        best: tuple[int, tuple, tuple] = (0, (), ())
        at = bisect_right(give, (room, 1 << 62)) - 1
        if at >= 0 and give[at][0] > 0:
            best = (give[at][0], (give[at],), ())
        for out in take:  # one for one: the largest that fits once `out` has left
            if best[0] == room:
                break
            at = bisect_right(give, (room + out[0], 1 << 62)) - 1
            if at >= 0 and give[at][0] - out[0] > best[0]:
                best = (give[at][0] - out[0], (give[at],), (out,))
        if best[0] < room and len(give) > 1:  # two for one
            for out in take:
                limit = room + out[0]
                low, high = 0, len(give) - 1
                while low < high and best[0] < room:
                    both = give[low][0] + give[high][0]
                    if both > limit:
                        high -= 1
                    else:
                        if both - out[0] > best[0]:
                            best = (both - out[0], (give[low], give[high]), (out,))
                        low += 1
        if best[0] <= 0:
            return False
        for x in best[1]:
            give.remove(x)
            insort(take, x)
        for x in best[2]:
            take.remove(x)
            insort(give, x)
        moved = best[0]
        self.fill[taker] += moved
        self.fill[giver] -= moved
        return True


def pack_sizes(sizes: list[int], capacity: int) -> list[int]:
    """The number of the bin of each item; sizes are from 1 to the capacity."""
    bins = Bins(capacity)
    bins.pack(sizes)
    bins.improve(keep=-(-sum(sizes) // capacity))
    out = [0] * len(sizes)
    used = 0
    for own in bins.items:
        for _, item in own:
            out[item] = used
        used += bool(own)
    return out


def _pack_group(capacity: int, level: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Packs the items of a task group by group; a container's number says round, group and bin."""
    held: list[pd.DataFrame] = []

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        number = pd.Series(pack_sizes(frame["size"].tolist(), capacity), index=frame.index)
        fill = frame["size"].groupby(number).transform("sum")
        return frame.assign(container=level * 2**50 + frame.grp.astype("int64") * 2**24 + number, closed=fill >= CLOSED * capacity)[["id", "piece", "size", "container", "closed"]]

    for batch in batches:
        for _, part in batch.groupby((batch.grp != batch.grp.shift()).cumsum(), sort=False):
            if held and held[-1].grp.iloc[0] != part.grp.iloc[0]:
                yield work(pd.concat(held, ignore_index=True))
                held = []
            held.append(part)
    if held:
        yield work(pd.concat(held, ignore_index=True))


def fill_containers(sizes: DataFrame, row: str, size: str, capacity: int, group: int = GROUP) -> DataFrame:
    """The row id, piece (0-based), from_token, n_tokens, container (BIGINT) and place (0-based): where each item is put.

    Items of at most `capacity` are never split; a larger one becomes pieces of the capacity and one of the rest. Full
    pieces fill a container each. Items of size 0 or null, and null ids, need no container. Repeated ids are items of their
    own; an empty table gives an empty result; extra columns are ignored.

    Items are dealt at random to groups of bounded size. A group is packed best fit, then improved by local search (see
    Bins.improve). Containers that stay underfull give their items to the next round, in fewer groups, so that what single
    groups could not fill is filled across them, until a round saves no container or no fewer can hold all; a round's groups
    hold `group` items, whatever the number of all.
    """
    kind = dict(sizes.dtypes)[row]
    items = sizes.where(F.col(row).isNotNull() & (F.col(size) > 0)).select(F.col(row).alias("id"), F.col(size).cast("bigint").alias("n"))
    cut = items.select("id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {capacity}"))).alias("piece"))
    pieces = checkpointed(cut.select("id", "piece", F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).cast("int").alias("size")))
    full = pieces.where(F.col("size") == capacity)
    done = full.select("id", "piece", "size", (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("container"))
    rest = pieces.where(F.col("size") < capacity)
    least = rest.agg(F.ceil(F.sum("size") / capacity)).first()[0] or 0
    level, kept, closed, open_before, before = 0, [done], 0, None, None
    while True:
        groups = max(1, -(-rest.count() // group))
        dealt = rest.select("id", "piece", "size", F.pmod(F.xxhash64("id", "piece", F.lit(level)), F.lit(groups)).cast("int").alias("grp"))
        together = dealt.repartition("grp").sortWithinPartitions("grp", "size", "id", "piece")
        packed = checkpointed(together.mapInPandas(partial(_pack_group, capacity, level), f"id {kind}, piece bigint, size int, container bigint, closed boolean"))
        used = packed.groupBy("container").agg(F.first("closed").alias("closed")).agg(F.count("*").alias("n"), F.count_if("closed").alias("closed")).first()
        if open_before is not None and used.n > open_before:  # the round before was better
            kept.append(before)
            break
        if groups == 1 or used.n == open_before or closed + used.n <= least:
            kept.append(packed)
            break
        kept.append(packed.where("closed"))
        closed, open_before, before, level = closed + used.closed, used.n - used.closed, packed.where("not closed"), level + 1
        rest = before.select("id", "piece", "size")
    done = reduce(DataFrame.unionByName, (part.select("id", "piece", "size", "container") for part in kept))
    # A container holds at most `capacity` items, so its list is bounded.
    listed = done.groupBy("container").agg(F.array_sort(F.collect_list(F.struct("id", "piece", "size"))).alias("items"))
    placed = listed.select("container", F.posexplode("items").alias("place", "item"))
    return placed.select(F.col("item.id").alias(row), "item.piece", (F.col("item.piece") * capacity).alias("from_token"), F.col("item.size").alias("n_tokens"), "container", "place")
