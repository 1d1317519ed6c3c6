import re

import __spark_entry__ as entry


def test_norm_ws_keeps_texts_outside_ascii(spark, tmp_path):
    texts = ["caf\u00e9  r\u00e9sum\u00e9\n", " \u201cstra\u00dfe\u201d\t\tx ", "\u7814\u7a76 data", "plain\r\n text", "", "   ", None, "\u0431\u044b\u043b\u043e", "a\u00a0b"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.teks for r in entry.queries()["norm_ws"](spark, str(tmp_path)).collect()}
    assert got == {i: re.sub(r"[\t\n\f\r ]+", " ", t).strip(" ").upper() for i, t in enumerate(texts) if t is not None and t.strip(" ")}
