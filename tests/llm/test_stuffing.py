from lumbung.llm import stuffing

PROSE = (
    "Penelitian ini membahas tata air lahan gambut dengan biaya rendah di wilayah pesisir. Data dikumpulkan dari warga, "
    "kemudian diperiksa ulang oleh dua pencacah yang berbeda. The method is described in full so that other groups can "
    "repeat it, and the appendix lists medians for every site. "
)



def prose(n):
    word = lambda i, j: f"{'bcdfgklmnprst'[(i * 7 + j * 5) % 13]}a{'bcdfgklmnprst'[(i + j * 3) % 13]}u{i}"
    return " ".join(f"Dengan {word(i, 1)} ini {word(i, 2)} yang diukur di {word(i, 3)} oleh {word(i, 4)} dan {word(i, 5)}." for i in range(n))


ATTENDANCE = "Daftar hadir:\n" + "\n".join(f"{i}. Sari{i} Budi{i} Anwar{i} - Teknik Mesin" for i in range(1, 30))
REFERENCES = "DAFTAR PUSTAKA\n" + "\n".join(
    f"[{i}] Nama{i}, B. (201{i % 10}). Kajian bahan bambu nomor{i}. Jurnal Mesin{i}, 1(2), 3-9. https://doi.example/10.9{i}/x{i}"
    for i in range(1, 25)
)
BUDGET = "No | Uraian | Volume | Jumlah\n" + "\n".join(f"{i} | kabel tembaga jenis{i} | {i} | {i}50000" for i in range(1, 30))


def test_spam():
    words = "sewa murah grosir bambu kopi sensor promo alat kampus buku viral hibah".split()
    salad = " ".join(words[i * i % 12] + words[(7 * i) % 12] for i in range(60))
    links = "\n".join(f"https://toko-{w}.example/beli-{v}-{i}" for i, (w, v) in enumerate(zip(words * 3, words[3:] * 4)))
    for text in (
        "jasa ketik proposal murah, " * 40,
        "promo " * 60,
        salad,
        links,
        " ".join(f"#{w}{i}" for i, w in enumerate(words * 3)),
        "\n".join(f"{w.upper()} {v} tipe A{i} Rp{i}5.000 [{v}] [{w}]" for i, (w, v) in enumerate(zip(words * 2, words[::-1] * 2))),
        "".join(f"Hubungi jasa olah data Kota{i} untuk jasa olah data murah, jasa olah data cepat. " for i in range(9)),
        "&lt;br&gt;".join(f'<a href="http://h{w}.example/x">{w} asli</a>' for w in words * 3),
    ):
        assert stuffing.spam_share(text) > 0.5, text[:80]


def test_no_spam():
    for text in (PROSE + prose(40), prose(5), ATTENDANCE, REFERENCES, BUDGET, "Kata kunci: " + ", ".join(f"bahan uji{i}" for i in range(40)), "", "  ",
                 prose(9) + "\njasa ketik murah, jasa ketik murah, jasa ketik murah", "研究" * 400, "judul saja tanpa isi"):
        assert stuffing.spam_share(text) <= 0.5, text[:80]
    assert stuffing.spam_share(None) == 0.0


def test_rows(spark):
    spam = "jasa ketik proposal murah " * 50
    rows = [(1, None), (2, ""), (3, spam), (3, spam), (4, PROSE), (5, prose(20000)), (6, spam * 1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as bagian_spam")
    assert sorted(r.doc_id for r in stuffing.stuffed(df).collect()) == [3, 3, 6]
    assert stuffing.stuffed(df.limit(0)).count() == 0


def test_lists_of_few_hosts_and_short_lists():
    for text in (
        "\n".join(f"https://toko.example/p/{i}" for i in range(1, 61)),
        "\n".join(f"Kopi {w} https://{h}.example/barang/{w}-{i}" for i, w in enumerate("sewa jual beli obral".split() * 5) for h in ("toko", "warung")),
        "\n".join(f"https://toko.example/p/{i}" for i in range(1, 12)),
        "\n".join(f"https://toko-{i}.example/p" for i in range(4)),
        "#kopi #obral #murah #grosir #sewa",
        "kopi, sewa murah, grosir alat, obral, bambu",
        "promo promo promo promo promo",
    ):
        assert stuffing.spam_share(text) > 0.5, text[:80]
    for text in (
        PROSE + "https://toko.example/p/1 " + PROSE + "https://toko.example/p/2 https://toko.example/p/3",
        "https://data.example/laporan/2020",
        "Rancang Bangun Sistem Irigasi Tetes Otomatis",
        "Kata kunci: kopi, bambu, sensor, gambut, alat",
        "caf\u00e9 r\u00e9sum\u00e9",
        "   !!!???... ",
        "Kami mengukur kopi, bambu, sensor, gambut dan alat",
    ):
        assert stuffing.spam_share(text) <= 0.5, text[:80]
