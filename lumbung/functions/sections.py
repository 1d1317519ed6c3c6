"""Sections of a document from its lines (page, y_position, text, font_size, is_bold), by the headings of a template.

Lines of many documents are processed together, by ``doc``; only the fuzzy comparison of headings runs in Python, on the few
lines that can be headings.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

STYLED, PLAIN = 0.75, 0.90
LEAST_SHARE = 0.4


def body_size(lines: DataFrame) -> DataFrame:
    """(doc, badan): the most frequent font size of each document; ties: the one seen first."""
    order = F.struct(F.col("page"), F.col("y_position"))
    counted = lines.groupBy("doc", "font_size").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = F.max_by("font_size", F.struct(F.col("n"), -F.col("first.page"), -F.col("first.y_position")))
    return counted.groupBy("doc").agg(best.alias("badan"))


def document_type(lines: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """(doc, jenis, bagian): the template most of whose headings occur in the lower-cased text; null below LEAST_SHARE."""
    text = lines.groupBy("doc").agg(F.lower(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "y_position", "text"))), lambda s: s["text"]), " ")).alias("teks"))
    shares = [
        F.struct(
            (sum(F.when(F.col("teks").contains(h.lower()), 1).otherwise(0) for h in heads) / F.lit(float(len(heads)))).alias("bagian"), F.lit(-k).alias("k"), F.lit(name).alias("jenis")
        )
        for k, (name, heads) in enumerate(templates.items())
        if heads
    ]
    best = text.withColumn("b", F.array_max(F.array(*shares)))
    return best.select("doc", F.when(F.col("b.bagian") >= LEAST_SHARE, F.col("b.jenis")).alias("jenis"), F.col("b.bagian").alias("bagian"))


def match_heading(text: str, headings: list[str], styled: bool) -> str | None:
    """The heading most alike, if the similarity reaches the threshold of its style."""
    text = " ".join(text.lower().split())
    best, score = None, 0.0
    for h in headings:
        ratio = SequenceMatcher(None, text, h.lower()).ratio()
        if ratio > score:
            best, score = h, ratio
    return best if score >= (STYLED if styled else PLAIN) else None


def sections(lines: DataFrame, headings: list[str], instructions: dict[str, str] | None = None) -> DataFrame:
    """(doc, judul, teks): text between consecutive headings, joined by blanks; the first hit of a title opens it.

    A line is styled as a heading if it is bold or larger than the document's body. Lines before the first heading belong to
    none. Known instruction texts are cut from the start of their section. Documents without headings give no row.
    """
    longest = max(map(len, headings), default=0) * 2

    @F.pandas_udf(T.StringType())
    def heading(texts: pd.Series, styled: pd.Series) -> pd.Series:
        return pd.Series([match_heading(t, headings, s) if isinstance(t, str) and 0 < len(t.strip()) <= longest else None for t, s in zip(texts, styled)], dtype=object)

    styled = F.coalesce(F.col("is_bold"), F.lit(False)) | F.coalesce(F.col("font_size") > F.col("badan"), F.lit(False))
    rows = lines.join(body_size(lines), "doc", "left").withColumn("__title", heading("text", styled))
    order = Window.partitionBy("doc").orderBy("page", "y_position")
    seen = F.row_number().over(Window.partitionBy("doc", "__title").orderBy("page", "y_position"))
    rows = rows.withColumn("__title", F.when(F.col("__title").isNotNull() & (seen == 1), F.col("__title")))
    rows = rows.withColumn("judul", F.last("__title", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    body = rows.where(F.col("judul").isNotNull()).groupBy("doc", "judul").agg(
        F.array_sort(F.collect_list(F.when(F.col("__title").isNull(), F.struct("page", "y_position", F.trim("text").alias("t"))))).alias("l")
    )
    text = F.array_join(F.transform("l", lambda s: s["t"]), " ")
    for title, known in (instructions or {}).items():
        cut = F.when(text.startswith(known), F.ltrim(F.substring(text, len(known) + 1, 1_000_000_000))).otherwise(text)
        text = F.when(F.col("judul") == title, cut).otherwise(text)
    return body.select("doc", "judul", F.trim(text).alias("teks"))
