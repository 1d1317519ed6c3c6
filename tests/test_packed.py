import itertools
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumbung.operators import packed

CASES = {
    'Sari Budi (198501), Ani (), Cici Dewi': ["Sari Budi|198501", "Ani|", "Cici Dewi|"],
    '"Ir. ""Ani"" Dewi","Budi, Sari (12345)"': ['Ir. "Ani" Dewi|', "Budi, Sari|12345"],
    '["Sari Dewi (12345)", "Budi A."]': ["Sari Dewi|12345", "Budi A.|"],
    "12345 - Sari Dewi, 23456 - Budi Anwar|": ["Sari Dewi|12345", "Budi Anwar|23456"],
    "1) Sari  Dewi NIP 12345 2) Budi Anwar\n3) Ani (NIM. 777777)": ["Sari Dewi|12345", "Budi Anwar|", "Ani|777777"],
    "Sari Dewi (12345); ;Budi Anwar [23456] dan Ani Tuti": ["Sari Dewi|12345", "Budi Anwar|23456", "Ani Tuti|"],
    "- Sari Dewi - 12345\r\n- Budi Anwar": ["Sari Dewi|12345", "Budi Anwar|"],
}


def test_scan_and_split(spark):
    rows = [(i, t, 9) for i, t in enumerate(CASES)] + [(90, None, 9), (91, " - ", 9), (92, "Tidak Ada", 9), (93, "", 9), (94, ";;|", 9)]
    rows += [(80, "Sari Dewi, S.T., M.T., Budi Anwar (12345)", 9), (80, "Sari Dewi, S.T., M.T., Budi Anwar (12345)", 9)]
    rows += [(100 + i, f"Sari Dewi{i} ({10000 + i}), Ani Tuti Budi{i} ()", 9) for i in range(40)]
    rows += [(70, "Dewi7, Sari", 9), (71, "; ".join(f"Nama Orang{i} ({10000 + i})" for i in range(3000)), 9)]
    df = spark.createDataFrame(rows, "id long, teks string, posisi int")
    got = {}
    for r in packed.split(df, "teks").collect():
        got.setdefault(r.id, []).append((r.posisi, f"{r.nama}|{r.nomor}"))
    for i, want in enumerate(CASES.values()):
        assert [x for _, x in sorted(got[i])] == want
    assert [x for _, x in sorted(got[80])] == ["Sari Dewi, S.T., M.T.|"] * 2 + ["Budi Anwar|12345"] * 2
    assert [x for _, x in sorted(got[70])] == ["Dewi7, Sari|"]
    assert len(got[71]) == 3000
    assert not {90, 91, 92, 93, 94} & set(got)
    assert packed.split(df.limit(0), "teks").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='ab, "();|[]-1\n.', max_size=40))
def test_scan_never_fails_and_keeps_letters(text):
    atoms = packed.scan(text)
    paths = packed.decode(atoms, {}, packed.Model([0.0] + [0.2] * 6, 10, 5, 2, 0.05))
    assert sorted(i for p in paths for i in p) == list(range(len(atoms)))
    assert all(a.name == a.name.strip() for a in atoms)


names = st.lists(st.tuples(st.sampled_from(["Sari Dewi", "Budi A. Anwar", "Ani Tuti"]), st.integers(10000, 99999)), min_size=1, max_size=6)


@settings(max_examples=100, deadline=None)
@given(names, st.sampled_from([", ", ";", " | ", "\n", " dan ", "\t"]))
def test_round_trip(people, sep):
    text = sep.join(f"{n} ({k})" for n, k in people)
    assert [(a.name, a.number) for a in packed.scan(text)] == [(n, str(k)) for n, k in people]


def paths_of(run):
    """All ways to cover a run with segments."""
    by_begin = {}
    for x in packed.segments(run):
        by_begin.setdefault(x.begin, []).append(x)

    def ways(at):
        if at == len(run):
            yield []
        for x in by_begin.get(at, ()):
            for rest in ways(x.end):
                yield [x, *rest]

    return list(ways(0))


parts = st.lists(st.tuples(st.sampled_from(["Sari", "Dewi Tuti", "S.T.", "Budi A.", "M.Sc."]), st.sampled_from([None, None, None, "123", ""]), st.booleans(), st.sampled_from(packed.OPEN)), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(parts, st.dictionaries(st.sampled_from(["n:sari", "n:dewi tuti", "n:tuti sari", "s:s t", "n:sari sari"]), st.floats(0.1, 50)))
def test_best_path_and_expected_counts_equal_a_look_at_all_paths(found, counts):
    atoms = [packed.Atom(n, k, None, o and k not in (None, ""), by) for n, k, o, by in found]
    atoms[0].new = True
    model = packed.Model([0.0, 0.3, 0.4, 0.1, 0.1, 0.05, 0.05], 100.0, 30.0, 10.0, 0.05, {by: 0.3 + 0.1 * k for k, by in enumerate(packed.OPEN)})
    ways = paths_of(atoms)
    weights = [math.exp(-sum(packed.cost(atoms, x, counts, model) for x in way)) for way in ways]
    best = packed.decode(atoms, counts, model)
    chosen = [k for k, way in enumerate(ways) if [list(range(x.begin, x.end)) for x in way] == best]
    assert max(weights[k] for k in chosen) >= max(weights) * (1 - 1e-9)
    want = {}
    for way, w in zip(ways, weights):
        for x in way:
            for key in (x.head, *(k for k, _ in x.suffixes)):
                want[key] = want.get(key, 0.0) + w / sum(weights)
    got = packed.expected(atoms, counts, model)
    for key, n in want.items():
        assert abs(got.get(key, 0.0) - n) < 0.02, (key, got.get(key), n)


def test_rounds_change_what_no_single_field_tells(spark):
    """Single names are rare among the plain fields, so '&' alone reads as part of a name; that each name stands with many
    others is seen only over the whole column."""
    pool = ["Andi", "Budi", "Citra", "Dewi", "Eka", "Fitri", "Gita", "Hadi", "Indra", "Joko"]
    plain = [(i, f"Nama{i} Orang{i} ({10000 + i})") for i in range(60)] + [(60, "Tunggal (99999)")]
    pairs = [(100 + i, f"{a} & {b}") for i, (a, b) in enumerate(itertools.combinations(pool, 2))]
    firm = [(500 + i, f"Sari & Rekan; Nama{i} Orang{i}") for i in range(9)]
    df = spark.createDataFrame(plain + pairs + firm, "id long, teks string")

    def split(rounds):
        out = {}
        for r in packed.split(df, "teks", rounds).collect():
            out.setdefault(r.id, []).append((r.posisi, r.nama))
        return {k: [n for _, n in sorted(v)] for k, v in out.items()}

    without, learned = split(0), split(packed.ROUNDS)
    assert all(without[k] == [t] for k, t in pairs)
    assert all(learned[k] == t.split(" & ") for k, t in pairs)
    assert all(learned[k] == ["Sari & Rekan", f"Nama{k - 500} Orang{k - 500}"] for k, _ in firm)


def test_native_core(spark):
    typed = ["Dr. Ir. Sari  Dewi", "S. Budi", "Dr.", "Prof. Ani-Tuti, M.Sc.", "", "a_b. C"]
    got = spark.createDataFrame([(t,) for t in typed], "v string").select(packed._native_core(F.col("v"))).collect()
    assert [r[0] for r in got] == [packed.core(t) for t in typed]


def test_hot_fields_and_values(spark):
    rows = [(i, "Sari Dewi, S.T., Budi Anwar") for i in range(300)] + [(1000 + i, f"Nama{i} Orang, S.T., Ani{i} Tuti (1234{i})") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, teks string")
    got = packed.split(df, "teks").groupBy("id").agg(F.max("posisi").alias("n")).collect()
    assert len(got) == 400 and all(r.n == 2 for r in got if r.id < 1000)
