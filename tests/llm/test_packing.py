from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lumbung.llm import packing


def best_fit_decreasing(sizes, capacity):
    free = []
    for s in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= s]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - s)
        else:
            free.append(capacity - s)
    return len(free)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_one_capacity_is_best_fit_decreasing(sizes):
    made = packing.plan(Counter(sizes), (40,))
    assert made.containers == best_fit_decreasing(sizes, 40)
    check(made, sizes)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_several_capacities(sizes):
    check(packing.plan(Counter(sizes), (10, 20, 40)), sizes)


def check(made, sizes):
    contents = Counter()
    for s, n in Counter(sizes).items():
        for c in made.place(s, np.arange(n)):
            contents[int(c)] += s
    assert len(contents) == made.containers
    for c, total in contents.items():
        capacity = int(made.capacities(np.array([c]))[0])
        assert total <= capacity and (capacity == 10 or capacity == 40 or total > 10) and capacity in (10, 20, 40)


def test_rows(spark):
    rows = [(i, 100) for i in range(900)] + [(1000 + i, 1 + i * 37 % 2300) for i in range(700)] + [(5000, None), (5001, 0), (5002, 9000), (5002, 9000)]
    df = spark.createDataFrame(rows, "doc_id long, n long").selectExpr("*", "'x' as wadah")
    got = packing.packed(df, "doc_id", "n", (2048,), buckets=3).collect()
    placed = Counter()
    whole = Counter()
    for r in got:
        placed[r.wadah] += r.panjang
        whole[r.doc_id] += r.panjang
    assert max(placed.values()) <= 2048
    assert whole == Counter({5002: 18000} | {i: n for i, n in rows if n and i != 5002})
    assert Counter(r.doc_id for r in got if r.doc_id < 5000 and dict(rows)[r.doc_id] <= 2048).most_common(1)[0][1] == 1
    assert len(placed) <= 1.02 * sum(placed.values()) / 2048 + 1
    assert packing.packed(df.limit(0), "doc_id", "n").count() == 0
    assert packing.fill(packing.packed(df, "doc_id", "n", (512, 1024, 2048))).count() >= 1


def test_a_size_of_many_items_is_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 50)
    df = spark.createDataFrame([(i, 300) for i in range(700)] + [(1000 + i, 1 + i) for i in range(300)], "doc_id long, n long")
    made = packing.packed(df, "doc_id", "n", (2048,))
    placed = Counter()
    for r in made.collect():
        placed[r.wadah] += r.panjang
    assert max(placed.values()) <= 2048 and made.count() == 1000 == made.select("doc_id").distinct().count()
    assert len(placed) <= 1.02 * sum(placed.values()) / 2048 + 1


def test_every_document_gets_its_container_of_several_lengths(spark):
    import __spark_entry__ as entry
    from lumbung.llm import tokens
    from lumbung.session import table

    rows = entry.queries()["p8_lengths_packed"](spark, entry.SMALLEST).collect()
    filled, capacity, length = {}, {}, {}
    for r in rows:
        filled[r.wadah] = filled.get(r.wadah, 0) + r.panjang
        assert capacity.setdefault(r.wadah, r.kapasitas) == r.kapasitas
        length[r.doc_id] = length.get(r.doc_id, 0) + r.panjang
    lengths = (256, 512, 1024, 2048)
    assert all(c == min(x for x in lengths if x >= filled[w]) for w, c in capacity.items())
    sizes = tokens.measured(table(spark, entry.SMALLEST, "documents"), keep=["doc_id"]).where("n_token > 0").collect()
    assert length == {r.doc_id: r.n_token for r in sizes}
