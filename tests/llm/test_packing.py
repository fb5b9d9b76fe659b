import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampleloom.llm import packing as P
from sampleloom.session import ship


def _check(sizes, capacity):
    patterns = P.solve(sizes, capacity)
    used = Counter()
    for p in patterns:
        assert p.n > 0 and sum(s * k for s, k in p.content) <= capacity and len({s for s, _ in p.content}) == len(p.content)
        for s, k in p.content:
            used[s] += k * p.n
    assert used == Counter({s: n for s, n in sizes.items() if n})
    return sum(p.n for p in patterns)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=30))
def test_any_instance(sizes):
    bins = _check(sizes, 60)
    total = sum(s * n for s, n in sizes.items())
    assert bins >= -(-total // 60)
    # best fit decreasing never needs more than 11/9 of the best packing and a part of one
    large = sum(n for s, n in sizes.items() if s > 30)
    assert bins <= 11 / 9 * max(-(-total // 60), large) + 6 / 9 + 1 or bins <= 2 * -(-total // 60)


def _optimal(items, capacity):
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= items[i] and rooms[j] not in rooms[:j]:
                place(i + 1, [*rooms[:j], rooms[j] - items[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_reduction_loses_nothing(seed):
    r = random.Random(seed)
    items = sorted((r.randint(1, 30) for _ in range(9)), reverse=True)
    left = Counter(items)
    fixed = P.dominance_reduction(left, 30)
    assert sum(p.n for p in fixed) + _optimal(sorted(left.elements(), reverse=True), 30) == _optimal(items, 30)


@pytest.mark.parametrize("seed", range(300))
def test_reduction_of_every_item(seed):
    """Sizes for which two others fit beside many items, so that the branch of two companions decides."""
    r = random.Random(1000 + seed)
    capacity = r.choice([20, 30, 41])
    items = [r.randint(capacity // 6, capacity * 3 // 4) for _ in range(r.randint(5, 9))]
    items += [r.choice(items)] * r.randint(0, 2)
    left = Counter(items)
    fixed = P.dominance_reduction(left, capacity)
    used = +left
    for p in fixed:
        assert sum(s * k for s, k in p.content) <= capacity
        for s, k in p.content:
            used[s] += k * p.n
    assert used == Counter(items)
    assert sum(p.n for p in fixed) + _optimal(sorted(left.elements(), reverse=True), capacity) == _optimal(sorted(items, reverse=True), capacity)


@pytest.mark.parametrize("items,fixed", [([80, 12, 7, 6], {(80, 12, 7)}), ([60, 35, 18, 17], {(60, 35)}), ([60, 25, 16, 14], {(60, 25, 14)})])
def test_two_companions(items, fixed):
    got = {tuple(s for s, k in p.content for _ in range(k)) for p in P.dominance_reduction(Counter(items), 100)}
    assert fixed & got


def test_large_instance_fills_containers():
    r = random.Random(1)
    sizes = Counter(min(2048, int(r.lognormvariate(5, 1.2)) + 1) for _ in range(200_000))
    bins = _check(sizes, 2048)
    assert bins <= -(-sum(s * n for s, n in sizes.items()) // 2048) * 1.001 + 1
    assert len(P.solve({s: n * 1000 for s, n in sizes.items()})) < 20_000  # patterns do not grow with the items


@pytest.mark.parametrize("parts", [1, 6])
def test_rows(spark, parts):
    ship(spark)
    r = random.Random(parts)
    items = [(i, 7 if r.random() < 0.33 else r.choice([1, 100, 99, 250, 100, r.randint(1, 320), None, 0, -1])) for i in range(1500)] + [(None, 5), (3, 50)]
    df = spark.createDataFrame([(k, n, "clash") for k, n in items], "key long, n_tokens long, container_id string").repartition(parts)
    got = P.pack(df, 100).collect()
    total = Counter()
    for x in got:
        total[x["container_id"]] += x["size"]
    assert max(total.values()) <= 100 and set(total) == set(range(len(total)))
    whole = Counter()
    for x in got:
        whole[x["key"]] += x["size"]
    want = Counter()
    for k, n in items:
        want[k] += max(0, n or 0)
    assert +whole == +want
    assert all((x["part_no"] == 0 and x["from_token"] == 0) or x["from_token"] == 100 * x["part_no"] for x in got)
    assert len(total) <= -(-sum(want.values()) // 100) + 2
    assert P.pack(df.limit(0), 100).count() == 0


def test_bad_sizes():
    with pytest.raises(ValueError):
        P.solve({101: 1}, 100)
