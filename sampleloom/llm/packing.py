"""Items of varying length into containers of a fixed capacity, with as little unused space as possible.

Only the histogram of item sizes matters to a packing, and it has at most ``capacity`` entries whatever the corpus holds,
so the instance is solved on the driver over (size, count) pairs:

1. Martello-Toth dominance reduction fixes sets that provably dominate every other set with the same item. Every item is
   tried, from the largest on, until none gives another set: an item beside which nothing fits; an item with one that fills
   its container; an item beside which one other fits, with the largest that does; and an item beside which two others fit,
   with the largest one if no two hold more, else with the largest one and the largest beside both if no other two are
   both larger than that.
2. Best fit decreasing packs the remainder, many equal containers at a time.

The solution is a list of container patterns with multiplicities. Each item finds its container from its rank among the
items of its size: a sum of earlier partitions plus a running count, so hot sizes are never gathered in one task.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.session import cut

CAPACITY = 2048


@dataclass(frozen=True)
class Pattern:
    """``n`` containers that each hold ``content`` (size, items), the sizes distinct."""

    content: tuple[tuple[int, int], ...]
    n: int


def _dominating(left: Counter, order: list[int], size: int, capacity: int) -> Counter | None:
    """The set that dominates every other set with an item of ``size``, if one can be proved to; ``order`` has the sizes ascending."""
    room = capacity - size
    count = lambda s: left[s] - (s == size)  # noqa: E731 - of the other items

    def smallest(above: int, n: int, without: int = 0) -> list[int]:
        """The ``n`` smallest other items over ``above``, less one of size ``without``."""
        found: list[int] = []
        for i in range(bisect_right(order, above), len(order)):
            s = order[i]
            found += [s] * min(count(s) - (s == without), n - len(found))
            if len(found) >= n:
                break
        return found

    def largest(limit: int, without: int = 0) -> int:
        """The largest other item up to ``limit``, less one of size ``without``; 0 if there is none."""
        for i in range(bisect_right(order, limit) - 1, -1, -1):
            if count(order[i]) - (order[i] == without) > 0:
                return order[i]
        return 0

    small = smallest(0, 3)
    first = largest(room)
    if not first:
        return Counter([size])
    if first == room or len(small) < 2 or small[0] + small[1] > room:
        return Counter([size, first])
    if len(small) > 2 and sum(small) <= room:
        return None  # three others fit: nothing is proved about this item
    second = largest(room - first, without=first)
    # beside the largest nothing over ``second`` fits, so a better pair would be two of the others that are over it
    over = smallest(second, 2, without=first)
    if second and (len(over) < 2 or sum(over) > room):
        return Counter([size, first, second])
    return Counter([size, first]) if first >= _largest_pair([s for s in order if s <= room and count(s) > 0], count, room) else None


def _largest_pair(sizes: list[int], count, room: int) -> int:
    """The most that two of the items hold together within ``room``; ``sizes`` ascend."""
    best, lo, hi = 0, 0, len(sizes) - 1
    while lo <= hi:
        a, b = sizes[lo], sizes[hi]
        if a + b > room:
            hi -= 1
            continue
        if a != b or count(a) > 1:
            best = max(best, a + b)
        if count(a) > 1 and 2 * a <= room:
            best = max(best, 2 * a)
        lo += 1
    return best


def dominance_reduction(left: Counter, capacity: int) -> list[Pattern]:
    """Fix dominating sets and take their items out of ``left``; repeated until no size yields another.

    A set is taken as often as its items last: what it is proved by stays true when such items are gone.
    """
    fixed: list[Pattern] = []
    order = sorted(s for s, n in left.items() if n)
    changed = True
    while changed:
        changed = False
        for size in order[::-1]:
            while left.get(size) and (found := _dominating(left, order, size, capacity)):
                n = min(left[s] // k for s, k in found.items())
                fixed.append(Pattern(tuple(sorted(found.items(), reverse=True)), n))
                for s, k in found.items():
                    left[s] -= k * n
                    if not left[s]:
                        del left[s]
                        order.pop(bisect_left(order, s))
                changed = True
    return fixed


def best_fit(left: Counter, capacity: int) -> list[Pattern]:
    """Best fit decreasing over size classes; containers with equal content move together."""
    open_at: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, content: tuple[tuple[int, int], ...], n: int) -> None:
        if n:
            if not open_at[room]:
                insort(rooms, room)
            open_at[room].append((content, n))

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            i = bisect_left(rooms, size)
            if i == len(rooms):  # new containers
                per = capacity // size
                put(capacity - per * size, ((size, per),), n // per)
                if n % per:
                    put(capacity - n % per * size, ((size, n % per),), 1)
                break
            room = rooms[i]
            content, count = open_at[room].pop()
            if not open_at[room]:
                rooms.pop(i)
            per = room // size
            whole = min(count, n // per)
            put(room - per * size, (*content, (size, per)), whole)
            n -= whole * per
            if whole < count:
                put(room, content, count - whole - (1 if n else 0))
                if n:
                    put(room - n * size, (*content, (size, n)), 1)
                    n = 0
    return [Pattern(content, n) for groups in open_at.values() for content, n in groups]


def solve(sizes: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that pack ``sizes`` (size -> items, sizes from 1 to ``capacity``)."""
    left = Counter({s: n for s, n in sizes.items() if n})
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("sizes must be from 1 to the capacity")
    return dominance_reduction(left, capacity) + best_fit(left, capacity)


def slots_of(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each size: first rank, first container and items per container of each pattern that holds it."""
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: Counter = Counter()
    container = 0
    for p in patterns:
        for size, per in p.content:
            rows[size].append((used[size], container, per))
            used[size] += per * p.n
        container += p.n
    return {s: tuple(np.array(x, np.int64) for x in zip(*r)) for s, r in rows.items()}


def pieces_of(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(key, part_no, from_token, size)``: an item over the capacity is split into full pieces and a rest."""
    last = F.floor((F.col("n_tokens") - 1) / capacity).cast("long")
    return (
        sizes.filter("n_tokens > 0")
        .select("key", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part_no"))
        .select("key", "part_no", (F.col("part_no") * capacity).alias("from_token"), F.least(F.lit(capacity), F.col("n_tokens") - F.col("part_no") * capacity).cast("int").alias("size"))
    )


def pack(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(key, part_no, container_id, from_token, size)`` for every piece of ``sizes (key, n_tokens)``.

    Null and non-positive sizes hold nothing and give no row. Equal keys are equal items, each packed on its own; ties in
    size are broken by key and part. An empty input gives an empty result.
    """
    pieces = pieces_of(sizes, capacity)
    n_parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges of (size, key) keep the (partition, size) pairs near the number of partitions; cut, as ranks need two passes
    ranged = cut(
        pieces.repartitionByRange(n_parts, "size", "key", "part_no")
        .sortWithinPartitions("size", "key", "part_no")
        .withColumn("at", F.spark_partition_id())
    )
    found = ranged.groupBy("at", "size").agg(F.count("*").alias("n")).collect()
    total: Counter = Counter()
    offset: dict[tuple[int, int], int] = {}
    for r in sorted(found, key=lambda r: r["at"]):
        offset[r["at"], r["size"]] = total[r["size"]]
        total[r["size"]] += r["n"]
    plan = sizes.sparkSession.sparkContext.broadcast((offset, slots_of(solve(total, capacity))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, slots = plan.value
        seen: Counter = Counter()
        for b in batches:
            at, size = np.asarray(b.column(4)), np.asarray(b.column(3))
            if not len(size):
                continue
            edge = np.r_[0, np.flatnonzero((np.diff(size) != 0) | (np.diff(at) != 0)) + 1, len(size)]
            container = np.empty(len(size), np.int64)
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                k = (int(at[lo]), int(size[lo]))
                rank = before[k] + seen[k] + np.arange(hi - lo)
                seen[k] += hi - lo
                first, base, per = slots[k[1]]
                i = np.searchsorted(first, rank, "right") - 1
                container[lo:hi] = base[i] + (rank - first[i]) // per[i]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(container), b.column(2), b.column(3)], names=["key", "part_no", "container_id", "from_token", "size"])

    columns = ["key", "part_no", "from_token", "size", "at"]
    return ranged.select(*columns).mapInArrow(assign, "key long, part_no long, container_id long, from_token long, size int")
