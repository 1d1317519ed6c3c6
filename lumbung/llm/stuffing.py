"""Keyword-stuffed pages, link lists and product tags.

Each text becomes a sequence of terms. Three signals are measured in windows of ``WINDOW`` terms, so that prose beside spam
is judged on its own:

* recurrence: gaps between occurrences of the same pair of neighbouring terms. A pair that occurs at least ``MIN_REPEATS``
  times with gaps of at most ``MAX_GAP`` is unnaturally regular; the share of such terms is smoothed over the window;
* autocorrelation: share of terms equal to the term ``lag`` places earlier, for each lag up to ``MAX_GAP``; its peak over
  lags marks strictly periodic texts, also those of a single repeated word;
* lists: windows with (almost) no function words, many distinct terms, tag marks or links to many hosts; links of few hosts
  where they hold most of a window's characters, so that a link beside prose is none.

Texts shorter than ``MIN_TERMS`` have no windows: their lists are at least ``MIN_LINKS`` links or tags, terms that occur
``MIN_REPEATS`` times, or ``MIN_ITEMS`` separated items without any function word (a title has no items).

Structured lists that belong to scholarly texts (references, attendance, budgets, contents, keyword lines) are known by the
layout of their lines and never count, unless their terms recur regularly. A text is spam when the flagged terms hold more
than half of its characters.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 24
MAX_GAP = 40
MIN_REPEATS = 4
LOW_FUNCTION = 0.05
REGULAR = 0.45
PERIODIC = 0.6
SALAD = 0.7
SHARE = 0.5
MIN_TERMS = 12
MIN_HOSTS = 3
MIN_LINKS = 3
MIN_ITEMS = 5

# Function words of Indonesian, Malay and English.
FUNCTION_WORDS = frozenset(
    """
    yang dan di ke dari untuk dengan pada adalah ini itu tidak bukan akan telah sudah belum masih oleh dalam atau juga
    karena sebab agar supaya sebagai lebih paling hanya dapat bisa harus perlu para serta tetapi tapi namun sedangkan ketika
    saat kami kita mereka ia dia saya anda bila jika kalau apabila maka sehingga antara bahwa hingga sampai secara kepada
    bagi tanpa selama setelah sesudah sebelum sejak setiap semua seluruh banyak beberapa suatu sebuah seorang saja pun lalu
    kemudian sangat cukup terlalu menurut mengenai tentang terhadap atas bawah apakah bagaimana mengapa siapa mana menjadi
    merupakan ialah yakni yaitu masing selain melalui bersama menggunakan berbasis guna pula ada mulai lain dua tersebut demikian adapun maupun meskipun walaupun
    the of and to in a an is for that with on as by it this be are was were been we i you he she they from at or not which
    who have has had do does did their our its his her more most than then but if so when while where what why how can could
    will would should may might must there here into over under about after before between during each every all some any
    other such only also very no one two for because however under
    """.split()
)

_TERM = re.compile(
    r"\n|(?:https?://|www\.)\S+(?: dot \S+)*|[#~@$]?[^\W\d_]+\d*(?:(?:(?:\.|-| dot )\w+)*(?:\.| dot )\w+/\S*)?|\d[\d.,]*"
)
_MARKUP = re.compile(r"""<a\s[^>]*?href\s*=\s*["']?([^"'>\s]+)[^>]*>|</?[a-zA-Z][^>]*>""")
_LINK = re.compile(r"(?:https?://|www\.)|[\w-]+(?:(?:\.| dot )[\w-]+)+/", re.I)
_HOST = re.compile(r"(?:https?://)?(?:www(?:\.| dot ))?([\w-]+(?:(?:\.| dot )[\w-]+)*)", re.I)
_LABEL = re.compile(
    r"(?:kata\s+kunci|keywords?|index\s+terms|tautan\s+data|daftar\s+(?:isi|pustaka|hadir)|references|contents)\b", re.I
)
_ENTRY = re.compile(r"\[?\d{1,4}[\].)]\s+\S.*(?:\(\d{4}\)|\.{4,}\s*\d+\s*$|\s-\s)")  # references, contents, attendance
_ROW = re.compile(r"\d{1,4}\s*\|.*\|\s*[\d.,]+\s*\|\s*[\d.,]+\s*$|[\w. ]{1,20}(?:\|[\w. ()]{1,30}){3}$")  # budgets


def _structured(line: str) -> bool:
    line = line.lstrip()
    if not line:
        return False
    if line[0].isdigit() or line[0] == "[":
        return bool(_ENTRY.match(line) or _ROW.match(line))
    return bool(_LABEL.match(line)) or "|" in line and bool(_ROW.match(line))


class _Terms(dict):
    """Numbers of terms, with what is known of each; starts anew when it has grown past MOST."""

    MOST = 400_000

    def __init__(self):
        super().__init__()
        self.weight = np.zeros(1024)
        self.function = np.zeros(1024, bool)
        self.latin = np.zeros(1024, bool)
        self.link = np.zeros(1024, bool)
        self.lowered: dict[str, int] = {}
        self.same = np.zeros(1024, np.int64)

    def __missing__(self, term: str) -> int:
        k = self[term] = len(self)
        if k >= len(self.weight):
            for name in ("weight", "function", "latin", "link", "same"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate((old, np.zeros_like(old))))
        lower = term.lower()
        self.weight[k] = len(term) if term != "\n" else 0
        self.function[k] = lower in FUNCTION_WORDS
        self.latin[k] = term.isascii()
        self.link[k] = len(term) > 8 and _LINK.match(term) is not None
        self.same[k] = self.lowered.setdefault(lower, k)
        return k


_KNOWN = [_Terms()]


def _around(flags: np.ndarray, size: int) -> np.ndarray:
    """Mean of ``flags`` in the window of ``size`` terms around each term, windows shifted inwards at the ends."""
    n = len(flags)
    size = min(size, n)
    total = np.concatenate(([0.0], np.cumsum(flags)))
    start = np.clip(np.arange(n) - size // 2, 0, n - size)
    return (total[start + size] - total[start]) / size


def _near(keys: np.ndarray, gap: int, repeats: int) -> np.ndarray:
    """Places of keys that recur: next to an equal key at most ``gap`` away, at least ``repeats`` times in such gaps."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    near = same & (np.diff(order) <= gap)
    out = np.zeros(len(keys), bool)
    if np.count_nonzero(near) < repeats - 1:
        return out
    group = np.concatenate(([0], np.cumsum(~same)))
    enough = np.bincount(group[1:], weights=near)[group[1:]] >= repeats - 1
    kept = near & enough
    out[order[1:][kept]] = True
    out[order[:-1][kept]] = True
    return out


def _pairs(ids: np.ndarray, function: np.ndarray) -> np.ndarray:
    """Terms of pairs without function words that recur at close, regular gaps."""
    marked = np.zeros(len(ids), bool)
    near = _near(ids[:-1] * (int(ids.max()) + 2) + ids[1:], MAX_GAP, MIN_REPEATS) & ~function[:-1] & ~function[1:]
    marked[:-1] |= near
    marked[1:] |= near
    return marked


def _periodic(ids: np.ndarray) -> np.ndarray:
    """Terms in stretches whose autocorrelation peaks: over six periods, most terms equal the term one lag away."""
    n = len(ids)
    marked = np.zeros(n, bool)
    for lag in range(1, min(MAX_GAP, n // 6) + 1):
        equal = ids[lag:] == ids[:-lag]
        if np.count_nonzero(equal) < 0.1 * n:
            continue
        either = np.zeros(n, bool)
        either[lag:] |= equal
        either[:-lag] |= equal
        marked |= _around(either, max(WINDOW, 6 * lag)) >= PERIODIC
    return marked


def _short(text: str, terms: list[str], ids: np.ndarray, function: np.ndarray, latin: np.ndarray, link: np.ndarray) -> np.ndarray:
    """Terms of lists in a text without a window."""
    tags = np.fromiter((t[0] in "#~@$" for t in terms), bool, len(terms))
    out = (np.bincount(ids)[ids] >= MIN_REPEATS) & ~function
    for marked in (tags, link):
        if np.count_nonzero(marked) >= MIN_LINKS:
            out |= marked
    if not function.any() and latin.mean() > 0.5:
        sizes = [n for item in re.split(r"[,;|\n]", text) if (n := sum(t != "\n" and not t[0].isdigit() for t in _TERM.findall(item)))]
        if len(sizes) >= MIN_ITEMS and max(sizes) <= 3:
            out[:] = True
    return out


def spam_share(text: str | None) -> float:
    """Share of the text's term characters that lie in spam; 0 for null and blank texts."""
    if not text:
        return 0.0
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _MARKUP.sub(r" \1 ", text)
    if len(_KNOWN[0]) > _Terms.MOST:
        _KNOWN[0] = _Terms()
    known = _KNOWN[0]
    end = known["\n"]
    terms = _TERM.findall(text)
    raw = np.fromiter((known[t] for t in terms), np.int64, len(terms))
    newline = raw == end
    n = len(raw) - np.count_nonzero(newline)
    if not n:
        return 0.0
    lines = np.fromiter((_structured(line) for line in text.split("\n")), bool)
    free = ~lines[np.cumsum(newline)[~newline]]
    ids = raw[~newline]
    weight, link, function, latin = known.weight[ids], known.link[ids], known.function[ids], known.latin[ids]
    ids = known.same[ids]
    if n < MIN_TERMS:
        flagged = free & _short(text, [t for t in terms if t != "\n"], ids, function, latin, link)
        return float(weight[flagged].sum() / weight.sum())
    pairs = _pairs(ids, function)
    regular = np.zeros(n, bool)
    if np.count_nonzero(pairs) * 4 >= WINDOW:
        regular |= _around(pairs, WINDOW) >= REGULAR
        regular |= _periodic(ids)
        regular &= free | (_around(pairs, WINDOW) >= PERIODIC)
    lists = np.zeros(n, bool)
    at = np.flatnonzero(free)
    if len(at) >= MIN_TERMS:
        size = min(WINDOW, len(at))
        ok = ~function[at]
        content = at[ok]
        # A text shorter than a window must have none at all: one function word in twenty terms may be prose.
        low = _around(~ok, size) <= (LOW_FUNCTION if size == WINDOW else 0.0)
        lists[at] = low & (_around(latin[at], size) > 0.5)
        if len(content) >= MIN_TERMS:  # word salad: content terms drawn again and again from a few
            again = _around(_near(ids[content], MAX_GAP, MIN_REPEATS), WINDOW) >= SALAD
            lists[content] |= again
    if link.any():
        hosts = {m[1].lower() for t in terms if len(t) > 8 and _LINK.match(t) and (m := _HOST.match(t))}
        if len(hosts) < MIN_HOSTS:
            run = np.zeros(n, bool)
            if np.count_nonzero(link[at]) >= MIN_LINKS:
                run[at] = link[at] & (_around(weight[at] * link[at], WINDOW // 2) > 0.5 * _around(weight[at], WINDOW // 2))
            lists = lists & ~link | run
        else:
            dense = np.zeros(n, bool)
            dense[at] = _around(link[at], WINDOW // 2) >= 0.15
            lists |= dense & link
    return float(weight[regular | lists].sum() / weight.sum())


@F.pandas_udf(T.DoubleType())
def _share(texts):
    return texts.map(lambda t: spam_share(t) if isinstance(t, str) else 0.0)


def shares(documents: DataFrame, text: str = "text", out: str = "bagian_spam") -> DataFrame:
    """Every row with its spam share; map-only, whole texts, no shuffle.

    Null, empty and blank texts have share 0; repeated rows stay repeated; a column named like ``out`` is
    replaced.
    """
    return documents.withColumn(out, _share(F.col(f"`{text}`").cast("string")))


def stuffed(documents: DataFrame, text: str = "text", share: float = SHARE) -> DataFrame:
    """Rows more than ``share`` of whose text is spam, with the column ``bagian_spam``."""
    return shares(documents, text).where(F.col("bagian_spam") > share)
