"""Names of persons: degrees and titles off, canonical spellings from a mapping or from the longest name of a root."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Degrees behind and titles before names.
DEGREES = """
S.T M.T M.Si S.Si M.Sc S.Pd M.Eng Ph.D S.T.P S.Farm S.Kom S.TP S.Hut M.Pd S.P M.Farm S.Kel M.Kom M.S.Farm M.Ars M.Cs
S.P.W.K M.S M.P.W.K S.Pi M.Ds S.Ds M.Sn M.T.P S.Sn M.Or M.Mat M.Ars.L PhD S.Ars S.Mat DEA IPU IPM Apt CISA MT ST SST SP MM
MS M.Ling M.Par M.R.K S.ST M.A S.S S.Pt M.EM M.P S.Far M.URP M.Arch M.Benv M.T.I S.Ci M.App.Sc S.Par S.Komp B.Eng C.Eng
M.M.Par M.Agr S.Sos M.Aktr M.I.P M.Komp D.Eng B.Sc MSME MURP M.Hum M.Han S.Gz S.S.T M.TP M.Log S.Stat D.E.A ST.Par M.U.D
M.PWK M.Eng.Sc M.Li M.I.A M.Stat MScTech M.Pharm.Sci M.Pharm.S S.Arsl M.Biotech M.Biomed M.Clin.Pharm M.Pharm S.S.I MS.Arch
B.Sc(Hons) PHD STP M.BEnv S.Si.Kom
""".split()
TITLES = ("Prof.", "Dr.Eng.", "Dr.-Ing.", "Dr.", "Ir.", "apt.", "Drs.", "Dr,-Ing.", "Ir,")
ORGANISATIONS = ("Yayasan", "Penerbit")

_PARTS = frozenset(tuple(d.upper().split(".")) for d in DEGREES)
_MOST_PARTS = max(map(len, _PARTS))
_EDGE = " .,"


def _without_bracket(text: str) -> str:
    """Without a bracket that is written onto the last word: 'M.Sc(Eng)' -> 'M.Sc', but 'M.Sc (Eng)' as it is."""
    if not text.endswith(")"):
        return text
    at = text.rfind("(")
    return text if at < 1 or text[at - 1].isspace() or ")" in text[at:-1] else text[:at].rstrip(".")


def _degree_at_end(text: str) -> int | None:
    """Where the degree begins that the text ends with, read as dotted parts from the right; None without one.

    Parts of a degree are joined by a dot and blanks; before its first part stands a dot, a comma or a blank.
    """
    parts: list[str] = []
    begin, end = None, len(text)
    while len(parts) < _MOST_PARTS:
        start = end
        while start and text[start - 1] not in _EDGE and not text[start - 1].isspace():
            start -= 1
        if start in (0, end):
            break
        parts.insert(0, text[start:end].upper())
        if tuple(parts) in _PARTS:
            begin = start
        end = len(text[:start].rstrip())
        if not end or text[end - 1] != ".":
            break
        end -= 1
    return begin


def _without_degrees(text: str) -> str:
    text = text.strip(_EDGE)
    while True:
        for ending in (text, _without_bracket(text).rstrip(".")):
            if (at := _degree_at_end(ending)) is not None:
                break
        else:
            return text
        text = text[:at].strip(_EDGE)


def _without_titles(text: str) -> str:
    while found := [t for t in TITLES if text[: len(t)].lower() == t.lower()]:
        text = text[max(map(len, found)) :].lstrip(", \t")
    return text.strip(_EDGE)


def root(name: str | None) -> str | None:
    """Upper-case name without degrees and titles; None for author lists cut with '...', organisations and empty names."""
    if name is None:
        return None
    text = str(name).replace("\xa0", " ").replace("\n", "").replace("\r", "").strip()
    cut_list = ",..." in text.replace(", ...", ",...")
    if cut_list or any(word in text for word in ORGANISATIONS):
        return None
    text = _without_degrees(text)
    if text.rfind("(") > text.rfind(")"):  # a bracket that was never closed
        text = _without_degrees(text[: text.rindex("(")])
    return " ".join(_without_titles(text).upper().split()) or None


def _root_udf():
    @F.pandas_udf(T.StringType())
    def run(names: pd.Series) -> pd.Series:
        return names.map(lambda n: root(n) if isinstance(n, str) else None)

    return run


def name_root(c: Column) -> Column:
    return _root_udf()(c)


def invalid_person(c: Column, rooted: Column | None = None) -> Column:
    """True for null, blank, names without a root and roots that hold a comma (several persons)."""
    rooted = name_root(c) if rooted is None else rooted
    return c.isNull() | (F.trim(c) == "") | rooted.isNull() | rooted.contains(",")


def longest_by_root(names: DataFrame, name: str) -> DataFrame:
    """(akar, kanonik): the longest name of each root without a comma; ties by the smaller text."""
    rooted = names.select(F.col(name).alias("kanonik"), name_root(F.col(name)).alias("akar")).where(F.col("akar").isNotNull() & ~F.col("akar").contains(","))
    return rooted.groupBy("akar").agg(F.min_by("kanonik", F.struct(-F.length("kanonik"), F.col("kanonik"))).alias("kanonik"))


def canonicalised(rows: DataFrame, name: str, lookup: DataFrame) -> DataFrame:
    """``rows`` with ``name`` replaced by the canonical name of its root; invalid and unknown names are only trimmed."""
    keep = rows.columns
    rooted = rows.withColumn("__root", name_root(F.col(name)))
    joined = rooted.join(lookup.select(F.col("akar").alias("__root"), F.col("kanonik").alias("__canonical")), "__root", "left")
    return joined.withColumn(name, F.coalesce("__canonical", F.trim(name))).select(*keep)


def mapped_names(rows: DataFrame, name: str, mapping: DataFrame) -> DataFrame:
    """``rows`` with names replaced by ``mapping`` (dari, menjadi): exact spelling first, then by root, else trimmed."""
    keep = rows.columns
    exact = mapping.groupBy(F.col("dari").alias(name)).agg(F.min("menjadi").alias("__exact"))
    by_root = mapping.withColumn("__root", name_root(F.col("dari"))).groupBy("__root").agg(F.min("menjadi").alias("__by_root"))
    joined = rows.join(exact, name, "left").withColumn("__root", name_root(F.col(name))).join(by_root, "__root", "left")
    return joined.withColumn(name, F.coalesce("__exact", "__by_root", F.trim(name))).select(*keep)
