"""Source mixing against the stated procedure."""

from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkflow.llm import mixing
from tests.llm.data import ROWS, docs, words


def stated_targets(sizes):
    """Targets by resharing the excess until none is above, as stated."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, out = 1.5 * sum(sizes.values()), {}
    active = list(names)
    while active:
        level = left / sum(weight[s] for s in active)
        over = [s for s in active if level * weight[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in active}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            active.remove(s)
    return out


def test_mix(spark):
    got = mixing.mix(docs(spark)).collect()
    size_of = Counter()
    for r in ROWS:
        size_of[r[3]] += len(words(r[1]))
    want = stated_targets(size_of)
    assert len(got) == len(ROWS)
    source = defaultdict(set)
    for r in ROWS:
        source[r[0]].add(r[3])
    taken = Counter()
    for g in got:
        assert g.taken in (0, g.size, 2 * g.size)
        s = next(s for s in source[g.doc_id] if abs(want[s] - g.target) < 1e-6 and size_of[s] == g.source_size)
        taken[s] += g.taken
    for s, t in want.items():
        assert taken[s] <= t + 1
    again = mixing.mix(docs(spark).repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix(docs(spark, [])).count() == 0


def test_repeated_gives_the_rows_of_the_mix(spark):
    df = docs(spark)
    rows = mixing.repeated(df)
    assert rows.columns == df.columns
    total = sum(len(words(r.text)) for r in rows.collect())
    assert total == sum(g.taken for g in mixing.mix(df).collect())


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 5), min_size=1, max_size=8), st.integers(0, 400))
def test_closest_sum_is_the_best(counts, budget):
    sums = {0}
    for v, n in counts.items():
        sums = {s + k * v for s in sums for k in range(n + 1)}
    chosen = mixing._closest(counts, budget)
    assert sum(chosen) == max(s for s in sums if s <= budget)
    assert all(c <= counts[v] for v, c in Counter(chosen).items())


@pytest.mark.parametrize("budget", [0, 1, 17, 4999, 123_456, 499_999])
def test_budget_is_met(budget):
    counts = {v: 40 for v in range(1, 160)}
    taken = mixing.fit_budget(counts, budget)
    assert all(0 <= taken[v] <= counts[v] for v in taken)
    assert sum(v * n for v, n in taken.items()) == min(budget, sum(v * n for v, n in counts.items()))


def _best_sum(counts, budget):
    sums = {0}
    for v, n in counts.items():
        sums = {s + k * v for s in sums for k in range(n + 1)}
    return max(s for s in sums if s <= budget)


@pytest.mark.parametrize("counts,budget", [
    ({50_000: 1, 40_000: 1, 35_000: 1}, 75_000),
    ({50_001: 2, 41_003: 3, 35_007: 2, 20_011: 1}, 199_000),
    ({90_000: 3, 60_000: 1, 45_500: 2, 31_000: 3, 17_001: 2}, 260_001),
    ({400_000: 1, 390_000: 2, 250_001: 2, 140_003: 3}, 1_010_006),
])
def test_sources_of_long_documents_come_closest(counts, budget):
    """Also where the first documents taken have to be given back."""
    assert min(counts) > mixing.REACH // 2
    taken = mixing.fit_budget(counts, budget)
    assert all(0 <= taken[v] <= counts[v] for v in taken)
    assert sum(v * n for v, n in taken.items()) == _best_sum(counts, budget)


def test_many_long_documents_meet_the_budget():
    counts = {17_000 + 331 * i + i * i % 97: 1 + i % 3 for i in range(120)}
    total = sum(v * n for v, n in counts.items())
    for budget in (total // 3, total // 2 + 1, 2 * total // 3):
        assert sum(v * n for v, n in mixing.fit_budget(counts, budget).items()) == budget


def test_plan_of_many_copies_needs_little_memory():
    """A length that most documents have: a record of sums for each of thousands of copies."""
    import tracemalloc
    counts = {60: 40_000, 90: 3_000, 7: 1}
    tracemalloc.start()
    got = mixing.fit_budget(counts, 1_682_109)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 1_682_109 - 2 == sum(v * n for v, n in got.items())
    assert all(n <= counts[v] for v, n in got.items())
    assert peak < 64 << 20
