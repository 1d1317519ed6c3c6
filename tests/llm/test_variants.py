import itertools
import math
import random
from collections import Counter

import numpy as np

from lumbung.llm import variants

NICK = {"budi": frozenset({"budiman"})}


def cost(typed, name):
    return variants.Aligner(NICK).name(variants.words_of(typed), variants.words_of(name))


def test_words():
    assert variants.words_of("Prof. Dr. Sari Dewi, S.T., M.Eng.") == ("sari", "dewi")
    assert variants.words_of("Anwar, Budiman Sari, M.Si") == ("budiman", "sari", "anwar")
    assert variants.words_of("  SARI-DEWI  Tuti.") == ("sari", "dewi", "tuti")
    assert variants.words_of(None) == variants.words_of("") == variants.words_of(" , .") == ()


def test_costs():
    for typed in ("Sari Dewantara Budiman", "S. Dewantara Budiman", "Sari Dewantara Budi", "Saridewantara Budiman", "Sari Dewan Tara Budiman",
                  "Budiman, Sari Dewantara", "Sari Dewnatara Budiman", "Sari Budiman", "Sari Dewantoro Boediman"):
        assert cost(typed, "Sari Dewantara Budiman") <= variants.MAX_COST, typed
    for typed in ("Sari Lestari Budiman", "Sari", "Kartika Putri", "S. D. B.", "Sari Dewantara Budiman Hakim"):
        found = cost(typed, "Sari Dewantara Budiman")
        assert found is None or found > variants.MAX_COST or typed == "S. D. B.", typed


def test_links(spark):
    people = [(1, "Sari Dewantara Budiman."), (2, "Kartika Putri Lestari."), (3, "Hakim Anwar."), (4, None), (5, "Sari Lestari Putri.")]
    typed = ["Sari Dewantara Budiman.", "SARI DEWANTARA BUDIMAN", "Kartika P. Lestari", "Anwar, Hakim", "Hakim Anwr", "Tim Penulis", "", None, "Prof.", "Sari Lestri Putri"]
    rows = [(i, t, 0) for i, t in enumerate(typed)] + [(90, "Hakim Anwr", 0)] + [(1000 + i, "Hakim Anwar", 0) for i in range(400)] + [(99, "x " * 3000, 0)]
    mentions = spark.createDataFrame(rows, "id int, ditulis string, nama int")
    entities = spark.createDataFrame(people, "k int, orang string")
    got = sorted((r.id, r.k) for r in variants.mentions_linked(mentions, "ditulis", entities, "k", "orang", NICK).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 3), (9, 5), (90, 3)] + [(1000 + i, 3) for i in range(400)]
    for a, b in ((mentions.limit(0), entities), (mentions, entities.limit(0))):
        assert variants.mentions_linked(a, "ditulis", b, "k", "orang", {}).count() == 0


def brute(typed, names):
    """Cosine of every pair, from the definition."""
    every = [set(variants.grams(n)) for n in (*typed, *names)]
    count = Counter(g for v in every for g in v)
    n = sum(count.values())
    weight = {g: math.log(1 + n / (1 + k)) for g, k in count.items()}
    norm = lambda v: math.sqrt(sum(weight[g] ** 2 for g in v))
    vectors = {x: set(variants.grams(x)) for x in (*typed, *names)}
    return weight, {(a, b): sum(weight[g] ** 2 for g in vectors[a] & vectors[b]) / (norm(vectors[a]) * norm(vectors[b])) for a in typed for b in names}


POOL = ["dewi", "sari", "lestari", "kusuma", "anwar", "budiman", "dewantara", "muhammad", "ayu", "m", "putri", "dwi", "wijayakusuma", "tjokro", "rahmawati"]


def test_join_gives_every_pair_of_the_threshold(spark, monkeypatch):
    """All pairs of the cosine threshold, in any number of blocks and groups, and the same rivals as a look at every pair."""
    draw = random.Random(6)
    names = sorted({" ".join(draw.sample(POOL, draw.choice((1, 2, 2, 3, 3, 4)))) for _ in range(150)})
    typed = sorted({w[: draw.randrange(3, 30)].strip() + draw.choice(("", "x", " ay")) for w in names} - set(names))
    weight, cosines = brute(typed, names)
    squares = {g: w * w for g, w in sorted(weight.items())}
    block = variants.Block(names, {g: k for k, g in enumerate(squares)}, np.array(list(squares.values())))
    want = {pair for pair, c in cosines.items() if c >= variants.COSINE + 1e-9}
    got = {(t, n): c for t in typed for c, n in block.near(t)}
    assert len(want) > 300 and want <= set(got) and all(abs(cosines[p] - c) < 1e-9 for p, c in got.items()) and min(got.values()) >= variants.COSINE - 1e-9
    align = variants.Aligner(NICK).name
    costs = {p: c for p in got if (c := align(tuple(p[0].split()), tuple(p[1].split()))) is not None}
    least = {t: min((c for (a, _), c in costs.items() if a == t), default=None) for t in typed}
    near = {p for p, c in costs.items() if c <= least[p[0]] + variants.DISPUTED + 1e-9}
    shared = spark.sparkContext.broadcast(("test", squares, NICK))
    rest = spark.createDataFrame([(t,) for t in typed], "__core string")
    known = spark.createDataFrame([(n,) for n in names], "__entity_core string")
    for size in (10_000, 40):
        monkeypatch.setattr(variants, "BLOCK", size)
        monkeypatch.setattr(variants, "GROUP", size)
        rows = variants._joined(rest, known, shared).collect()
        met = {(r[0], r[1]) for r in rows if r[3] <= least[r[0]] + variants.DISPUTED + 1e-9}
        assert met == near


def test_limit_of_the_check_changes_no_cost():
    draw = random.Random(7)
    align = variants.Aligner(NICK).name
    for _ in range(3000):
        a, b = (tuple(draw.sample(POOL, draw.choice((1, 2, 3)))) for _ in range(2))
        a = tuple(w[: draw.randrange(1, len(w) + 1)] for w in a)
        whole, limit = align(a, b), draw.choice((0.3, 0.9, 1.5, 2.6))
        assert align(a, b, limit) == (whole if whole is not None and whole <= limit else None), (a, b, limit)


def test_links_do_not_depend_on_how_many_entities_share_a_word(spark):
    """The same three names among 3 and among 1,003 entities of which a thousand share two of their words."""
    people = [(i, f"Sari Dewi {w}") for i, w in enumerate(["Lestari", "Kusuma", "Pratama"])]
    crowd = [(1000 + i, f"Sari Dewi {a}{b}{c}") for i, (a, b, c) in enumerate(itertools.product(["bo", "ga", "ti", "mu", "zo", "he", "pa", "ri", "nu", "we"], repeat=3))]
    mentions = spark.createDataFrame([(1, "Sari Dewi Lestri"), (2, "Sari D. Kusuma"), (3, "Sari Dewi Pratma"), (4, "Dwei Kusuma Sari")], "id int, ditulis string")
    for rows in (people, people + crowd):
        entities = spark.createDataFrame(rows, "k int, orang string")
        got = sorted((r.id, r.k) for r in variants.mentions_linked(mentions, "ditulis", entities, "k", "orang", {}).collect())
        assert got == [(1, 0), (2, 1), (3, 2), (4, 1)]


def test_namesakes_are_told_by_their_titles(spark):
    entities = spark.createDataFrame([(1, "Sari Dewi Lestari"), (2, "Prof. Sari Dewi Lestari"), (3, "Drs. Sari Dewi Lestari")], "k int, orang string")
    typed = ["Sari Dewi Lestari", "Prof Sari Dewi Lestari", "PROF. Sari D Lestari", "Drs. Sari Dewi Lestri", "Sari Dewi Lestri", "Ir. Sari Dewi Lestari"]
    mentions = spark.createDataFrame(list(enumerate(typed)), "id int, ditulis string")
    got = sorted((r.id, r.k) for r in variants.mentions_linked(mentions, "ditulis", entities, "k", "orang", {}).collect())
    assert got == [(1, 2), (2, 2), (3, 3), (4, 1), (5, 1)]


def test_average_linkage_is_the_mean_cosine_to_all_members(spark):
    names = ["sari dewi lestari", "sari dewi kusuma", "sari d lestari", "sari dewi lestri", "sari dwi kusuma", "s dewi kusuma"]
    weight, cosines = brute(names, names)
    shared = spark.sparkContext.broadcast(("mean", {g: w * w for g, w in sorted(weight.items())}, {}))
    clusters = {names[0]: [names[0], names[2], names[3]], names[1]: [names[1], names[4]]}
    members = spark.createDataFrame([(m, c) for c, ms in clusters.items() for m in ms], "__member string, __entity_core string")
    disputed = spark.createDataFrame([(names[5], c, 1.0) for c in clusters], "__core string, __entity_core string, __cost double")
    got = {r["__entity_core"]: r["__linkage"] for r in variants._linkage(disputed, members, shared).collect()}
    for c, ms in clusters.items():
        assert abs(got[c] - sum(cosines[names[5], m] for m in ms) / len(ms)) < 1e-9


def test_groups_equal_plain_average_linkage(spark):
    draw = random.Random(8)
    people = [" ".join(draw.sample(POOL, 3)) for _ in range(25)]
    typed = set(people)
    for p in people:
        for _ in range(4):
            at = draw.randrange(len(p))
            typed.add(draw.choice((p[:at] + p[at + 1 :], p[:at] + "e" + p[at:], " ".join(reversed(p.split())), p.replace(p.split()[0], p[0], 1))).strip())
    names = sorted({" ".join(variants.words_of(t)) for t in typed} - {""})
    _, cosines = brute(names, names)
    clusters = [[n] for n in names]
    while True:
        means = {(i, j): sum(cosines[a, b] for a in x for b in y) / (len(x) * len(y)) for j, y in enumerate(clusters) for i, x in enumerate(clusters[:j])}
        (i, j), best = max(means.items(), key=lambda m: m[1])
        if best < variants.LINKAGE:
            break
        clusters[i] += clusters.pop(j)
    want = {frozenset(c) for c in clusters}
    rows = [(n,) for n in names] + [(None,), ("",), ("Prof.",)]
    got = {}
    for r in variants.grouped(spark.createDataFrame(rows, "nama string"), "nama").collect():
        got.setdefault(r.kelompok, set()).add(r.nama)
    assert {frozenset(c) for c in got.values()} == want and 1 < len(want) < len(names) and all(k == min(c) for k, c in got.items())
    assert variants.grouped(spark.createDataFrame([], "nama string"), "nama").count() == 0
