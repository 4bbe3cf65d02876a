import random
from collections import Counter, defaultdict

import pytest
from corpus_fixtures import edge_docs, no_docs  # noqa: F401  (fixtures)
from regpanel.llm import op2_packing as pk


def brute(histogram, capacities):
    """Piece by piece: the bin with least room that has enough, else a new one."""
    left, lengths, bins = dict(histogram), sorted(histogram), []
    for length in sorted(histogram, reverse=True):
        capacity = None
        for _ in range(histogram[length]):
            fit = [b for b in bins if b[1] >= length]
            if fit:
                b = min(fit, key=lambda b: (b[1], b[0]))
            else:
                capacity = capacity or pk.cheapest_capacity(length, left, lengths, capacities)
                b = [capacity, capacity]
                bins.append(b)
            b[1] -= length
            left[length] -= 1
    return Counter((c, r) for c, r in bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_on_the_histogram_equals_placing_piece_by_piece(seed):
    rng = random.Random(seed)
    capacities = sorted(rng.sample(range(8, 60), rng.randint(1, 4)))
    histogram = Counter(rng.randint(1, capacities[-1]) for _ in range(rng.randint(1, 200)))
    plan = pk.plan_bins(histogram, capacities)
    got = Counter()
    numbers = defaultdict(list)
    for b in plan:
        got[b.capacity, b.room] += b.count
        assert sum(n * k for n, k, _ in b.runs) == b.capacity - b.room
        for n, k, first in b.runs:
            numbers[n].append((first, first + k * b.count))
    assert got == brute(histogram, capacities)
    for n, k in histogram.items():
        runs = sorted(numbers[n])
        assert runs[0][0] == 0 and runs[-1][1] == k and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))


def test_capacity_choice_prefers_the_cheaper_filling():
    # Two pieces of 30 fill 60 exactly; alone in 32 a piece costs more per token with this overhead.
    assert pk.cheapest_capacity(30, {30: 2}, [30], (32, 60)) == 60
    assert pk.cheapest_capacity(30, {30: 1}, [30], (31, 60)) == 31


def brute_anew(histogram, capacities):
    """Piece by piece; every opened bin is priced with the pieces that no earlier bin counts on."""
    def filling(capacity):
        room, used = capacity - length, Counter({length: 1})
        for size in sorted(free, reverse=True):
            while size <= min(room, length) and used[size] < free[size]:
                used[size] += 1
                room -= size
        size = min(c for c in capacities if c >= capacity - room)
        return pk.cost(size) / (capacity - room), capacity, used

    free, bins = Counter(histogram), []
    for length in sorted(histogram, reverse=True):
        for todo in range(histogram[length], 0, -1):
            fit = [b for b in bins if b[1] >= length]
            if fit:
                b = min(fit, key=lambda b: (b[1], b[0]))
            else:
                free[length] = todo
                _, capacity, used = min((filling(c) for c in sorted(capacities) if c >= length), key=lambda f: f[:2])
                free.subtract(used)
                b = [capacity, capacity]
                bins.append(b)
            b[1] -= length
    return Counter((c, r) for c, r in bins)


def price(bins, capacities):
    return sum(k * pk.cost(min(x for x in capacities if x >= c - r)) for (c, r), k in bins.items())


@pytest.mark.parametrize("seed", range(40))
def test_plan_decides_at_every_opened_bin(seed):
    rng = random.Random(seed)
    capacities = sorted(rng.sample(range(8, 60), rng.randint(1, 4)))
    histogram = Counter(rng.randint(1, capacities[-1]) for _ in range(rng.randint(1, 200)))
    histogram[rng.randint(1, capacities[-1])] += 100
    got, numbers = Counter(), defaultdict(list)
    for b in pk.plan_bins(histogram, capacities, anew=True):
        got[b.capacity, b.room] += b.count
        for n, k, first in b.runs:
            numbers[n].append((first, first + k * b.count))
    expected = brute_anew(histogram, capacities)
    assert got == expected
    for n, k in histogram.items():
        runs = sorted(numbers[n])
        assert runs[0][0] == 0 and runs[-1][1] == k and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
    used = Counter()
    for b in pk.least_cost_plan(histogram, capacities):
        used[b.capacity, b.room] += b.count
    assert price(used, capacities) == min(price(expected, capacities), price(brute(histogram, capacities), capacities))


def test_a_rare_filler_does_not_size_the_bins_of_a_hot_length(spark):
    # One bin of 1024 holds 600 + 424; the other pieces are cheapest six to a bin of 4096.
    plan = pk.least_cost_plan({600: 1_000_000, 424: 1})
    assert pk.total_cost(plan, pk.CAPACITIES) < 1.15 * 600 * 1_000_000
    docs = spark.createDataFrame([(i, " ".join(["w"] * (600 if i else 424))) for i in range(62)], "doc_id long, text string").repartition(3)
    bins = check(pk.pack(docs).collect(), pk.CAPACITIES)
    assert Counter((m[0].bin_length, sum(r.n_tokens for r in m)) for m in bins.values()) == {(4096, 3600): 10, (1024, 1024): 1}


def check(rows, capacities):
    bins = defaultdict(list)
    for r in rows:
        if r.n_tokens:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None and r.bin_length is None
    for members in bins.values():
        members.sort(key=lambda r: r.bin_offset)
        end = 0
        for r in members:
            assert r.bin_offset == end
            end += r.n_tokens
        assert {r.bin_length for r in members} == {min(c for c in capacities if c >= end)}
    return bins


def test_documents_are_packed_whole(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * n)) for i, n in enumerate([rng.randint(0, 90) for _ in range(300)] + [17] * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = pk.pack(docs, (16, 32, 64)).collect()
    bins = check(got, (16, 32, 64))
    total = Counter()
    for r in got:
        total[r.doc_id] += r.n_tokens
        assert r.first_token == r.piece * 64
    assert total == Counter({i: len(t.split()) for i, t in rows})
    histogram = Counter(r.n_tokens for r in got if r.n_tokens)
    expected = Counter()
    for (c, room), k in brute(histogram, (16, 32, 64)).items():
        expected[min(x for x in (16, 32, 64) if x >= c - room), c - room] += k
    assert expected == Counter((m[0].bin_length, sum(r.n_tokens for r in m)) for m in bins.values())


def test_edge_rows(edge_docs, no_docs):
    got = pk.pack(edge_docs).collect()
    check(got, pk.CAPACITIES)
    pieces = Counter(str(r.doc_id) for r in got)
    assert pieces["5"] == 2 and pieces["None"] == 1 and pieces["4"] == -(-60_000 // 4096) and pieces["2"] == 1
    assert pk.pack(no_docs).collect() == []
