import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lumbung.llm import canonical
from lumbung.llm.queries import REFERENCES, RULES

words = st.text(alphabet="abcd ", max_size=12)


def plain_distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_distance(a, b):
    assert canonical.distance(a, b) == plain_distance(a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(words, max_size=30), words, st.integers(0, 4))
def test_tree_gives_every_key_in_the_radius(keys, query, radius):
    tree = canonical.BKTree(keys)
    assert {k for _, k in tree.find(query, radius)} == {k for k in keys if plain_distance(k, query) <= radius}


ENTRIES = {1: "Riset Dasar Mandiri", 2: "Riset Terapan Mitra Desa (RTMD)", 3: "Karya Buku Ajar", 4: "Karya Buku Monograf"}
CASES = {
    "Riset Dasar Mandiri": 1, "riset_dasar-mandiri ": 1, "RDM": 1, "Riest Daasr Mandiri": 1, "Mandiri Dasar Riset": 1, "RTMD": 2, "Karya Buku": 0,
    "Skema Riset Dasar Mandiri 2024": 1, "Karya Buku Mo": 4, "Rist. Tera. Mitra Desa": 2, "Textbook Writing": 3, "Lomba Robot": 0, "12": 0, "??": 0,
}


def test_values_and_shards(spark):
    rows = [(i, v, 7) for i, v in enumerate(CASES)] + [(50, None, 7), (51, "", 7), (52, "RTMD", 7), (52, "RTMD", 7), (53, "buku " * 5000, 7)]
    df = spark.createDataFrame(rows, "id int, nilai string, ref_id int")
    ref = spark.createDataFrame([*ENTRIES.items(), (9, None)], "k int, n string")
    got = {r.id: r.ref_id for r in canonical.mapped(df, "nilai", ref, "k", "n", RULES["skema"]).collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())
    assert (got[50], got[51], got[52], got[53]) == (None, 0, 2, 0)
    for shards in (2, 3, 5):
        sharded = canonical.mapped(df, "nilai", ref, "k", "n", RULES["skema"], shards=shards, group=4).collect()
        assert len(sharded) == len(rows) and {r.id: r.ref_id for r in sharded} == got
    assert canonical.mapped(df, "nilai", ref.limit(0), "k", "n", RULES["skema"]).where("ref_id <> 0").count() == 0
    assert canonical.mapped(df.limit(0), "nilai", ref, "k", "n", RULES["skema"]).count() == 0


def test_typos_of_every_entry():
    matcher = canonical.Matcher(ENTRIES, RULES["skema"])
    rng = random.Random(3)
    for k, name in ENTRIES.items():
        for _ in range(200):
            at = rng.randrange(len(name))
            typo = name[:at] + rng.choice("aeiourst") + name[at + rng.randrange(2) :]
            assert matcher.match(typo)[0] == k, typo


def test_shards_never_change_an_answer(spark):
    """All values of the test tables, against the list and against a list with near, equal and longer entries besides."""
    values = spark.read.parquet("/root/testdata/sf0.01/silver_penelitian.parquet")
    for column, (name, key, label) in REFERENCES.items():
        entries = {r[0]: r[1] for r in spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").select(key, label).collect()}
        more = {100 + k: n + tail for k, n in entries.items() for tail in (" Lanjut",)} | {200 + k: n.replace("a", "e", 1) for k, n in entries.items()} | {300: next(iter(entries.values()))}
        typed = [r[0] for r in values.select(column).where(f"{column} IS NOT NULL").distinct().collect()]
        for listed in (entries, entries | more):
            whole = canonical.Matcher(listed, RULES[column])
            for shards in (2, 5):
                parts = [canonical.Matcher({k: n for k, n in listed.items() if k % shards == s}, RULES[column]) for s in range(shards)]
                for v in typed:
                    assert canonical.decide(v, [f for p in parts for f in p.find(v)], RULES[column]) == whole.match(v), v


def test_rules_find_what_a_look_at_every_entry_finds():
    draw = random.Random(5)
    pool = ["riset", "dasar", "mandiri", "terapan", "mitra", "desa", "karya", "buku", "ajar", "rintisan", "dosen"]
    entries = {k: " ".join(draw.sample(pool, draw.choice((1, 2, 2, 3, 4)))).title() for k in range(300)}
    matcher = canonical.Matcher(entries, RULES["prodi"])
    for _ in range(400):
        name = draw.choice(list(entries.values())).lower()
        form = draw.choice((name[: draw.randrange(1, len(name) + 1)].strip(), " ".join(w[: draw.randrange(1, len(w) + 1)] for w in name.split())))
        words = form.split()

        def fits(n):
            parts = n.split()
            cut = form != n and n.startswith(form) and len(form) >= 0.5 * len(n)
            return len(form.replace(" ", "")) >= 6 and (cut or len(words) == len(parts) and all(p.startswith(w) and len(w) > 1 for w, p in zip(words, parts)))

        assert matcher._prefixed(form) == {k for k, n in entries.items() if fits(n.lower())}, form
        assert set(matcher._begun(form)) == {k for k, n in entries.items() if n.lower().startswith(form)}
