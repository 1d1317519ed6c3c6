"""Several values packed in one field, split into one value per row with its position.

A field is scanned into atoms: quoted spans stay atomic, numbers in brackets or behind labels close a value, and line ends,
semicolons, bars and list numbers always separate. What a comma, 'dan', 'serta', 'and', '&' or '/' does is open: it may
separate two values or stand inside one (before a title, in an inverted name, in 'Sari & Rekan'). All readings of the open
delimiters of a field form a lattice of segments, priced by frequencies of whole values, of suffixes and of value lengths
and by how often each delimiter separates. All of these are learned by expectation-maximisation over the whole column: values
of fields without open delimiters count first, the others by their expected counts (forward-backward over each lattice), until
the delimiters' shares stand still. The Viterbi path under the last model splits the field.

Distribution: fields are scanned once, in one pass that gives the rows of plain fields and the atoms of the others.
Frequencies are a grouped count; only values that occur in lattices meet them, by a join that treats hot values apart, so no
table of values is ever broadcast. Only the length and delimiter tables (at most two dozen entries) reach the driver. Equal
fields are decoded once.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.operators.skew import hot_keys, lookup
from lumbung.session import cut

# Stand-ins for null.
NULLS = frozenset({"", "-", "--", "–", "nan", "none", "null", "n/a", "na", "nat", "tidak ada", "nihil", "kosong", "."})

LENGTHS = 7
ROUNDS = 6
STILL = 0.01  # the rounds end when no delimiter's share moves more
SEPARATES = 0.9  # share of an open delimiter before anything is learned
JOINT = 0.01  # prior share of values not seen before that hold a delimiter
INVERTED = 0.05
LEAST = 1e-3  # expected counts below are left out
OPEN = (",", "dan", "serta", "and", "&", "/")
_LABEL = r"(?:N\.?I\.?[PMDK]\.?|NIDN|NIDK|NPM|NRP|No)\s*[.:]?\s*"
_CLOSER = re.compile(rf"\s*(?:[\[(]\s*(?:{_LABEL})?([\d .-]*)[\])]|[-–:]\s+(?:{_LABEL})?(\d{{4,}})|\b{_LABEL}(\d{{4,}})|\s(\d{{5,}}))\s*$", re.I)
_OPENER = re.compile(rf"^\s*(?:{_LABEL})?(\d{{5,}})\s*(?:[-–:]\s+|\s)", re.I)
_BULLET = re.compile(r"^\s*(?:\d{1,3}\s*[.)](?=\s|[^\W\d])|[-•*·–]\s)\s*")
_HARD = re.compile(r"[;|\r\n\t]|(?:(?<=\s)|(?<=[)\]]))(?=\d{1,3}[.)]\s+\D)|(?:(?<=\d\d\d\d[)\]])|(?<=\s\(\)))\s+(?=[^\W\d])(?!(?:dan|serta|and)\s)")
_SOFT = re.compile(r",?\s+(dan|serta|and)\s+|\s([/&])\s|(,)")
_GROUP = re.compile(r"[\[(][^\[\]()]*[\])]")
_SPACE = re.compile(r"\s+")
_NO_DIGIT = re.compile(r"\D")


@dataclass
class Atom:
    name: str
    number: str | None  # None: no number; "" : an empty one, which closes the value all the same
    new: bool | None  # begins a value; None: open
    opened: bool = False  # its number stands before the name
    by: str = ","  # the delimiter before it


def _spaces(text: str) -> str:
    return " ".join(text.split())


def _quoted(text: str, at: int) -> tuple[str, int]:
    """Contents of the quoted span that begins at ``at``, and the place behind it; doubled or escaped quotes are one."""
    end, part = at + 1, []
    while end < len(text):
        if text[end] == "\\" and end + 1 < len(text):
            part.append(text[end + 1])
            end += 2
        elif text[end] == '"':
            if text[end + 1 : end + 2] != '"':
                break
            part.append('"')
            end += 2
        else:
            part.append(text[end])
            end += 1
    return "".join(part), end + 1


def _pieces(text: str) -> Iterator[tuple[str, bool]]:
    """Texts between strong delimiters, and whether they are a quoted span."""
    start = at = 0
    hard, quote = _HARD.search(text), text.find('"')
    while hard or quote >= 0:
        if quote >= 0 and (hard is None or quote <= hard.start()):
            if text[start:quote].strip(" \t,;[|"):  # a quote inside a value
                at = quote + 1
            else:
                span, at = _quoted(text, quote)
                yield span, True
                start = at
        else:
            yield text[start : hard.start()], False
            start, at = hard.end(), max(hard.end(), hard.start() + 1)
        if hard and hard.start() < at:
            hard = _HARD.search(text, at)
        if 0 <= quote < at:
            quote = text.find('"', at)
    yield text[start:], False


def _number(text: str) -> tuple[str, str | None, bool]:
    """Name, number and whether the number came first."""
    if closer := _CLOSER.search(text):
        number = next((g for g in closer.groups() if g is not None), "")
        return text[: closer.start()], _NO_DIGIT.sub("", number), False
    if opener := _OPENER.match(text):
        return text[opener.end() :], opener[1], True
    return text, None, False


def _soft(text: str) -> Iterator[tuple[str, str]]:
    """Texts between open delimiters outside brackets, with the delimiter before each."""
    if "," not in text and " " not in text:
        yield ",", text
        return
    masked = _GROUP.sub(lambda m: "(" * len(m[0]), text) if "(" in text or "[" in text else text
    start, by = 0, ","
    for m in _SOFT.finditer(masked):
        yield by, text[start : m.start()]
        start, by = m.end(), m[1] or m[2] or m[3]
    yield by, text[start:]


def scan(text: str | None) -> list[Atom]:
    """Atoms of a field; none for null and its stand-ins."""
    if text is None or _spaces(text).lower() in NULLS:
        return []
    text = text.strip()
    if text[:1] == "[" and text[-1:] == "]" and '"' in text:
        text = text[1:-1]
    out: list[Atom] = []
    for piece, quoted in _pieces(text):
        if quoted:
            name, number, opened = _number(_spaces(piece))
            if name.strip() or number:
                out.append(Atom(_spaces(name), number, True, opened))
            continue
        piece = _BULLET.sub("", piece, count=1)
        first = True
        for by, part in _soft(piece):
            name, number, opened = _number(part)
            name = _spaces(_BULLET.sub("", name) if first or by != "," else name).strip(" ,;:|/")
            if name[-1:] in ("-", "–") and name[-2:-1].isspace():
                name = name[:-1].rstrip()
            if name.lower() in NULLS and not number:
                if name == "" and number == "" and out and out[-1].number is None and not first:
                    out[-1].number = ""
                continue
            if not name and out and out[-1].number is None and not opened:
                out[-1].number = number
            elif name:
                closed = bool(out) and out[-1].number is not None and not out[-1].opened
                out.append(Atom(name, number, True if first or opened or closed else None, opened, by))
            first = False
    if out:
        out[0].new = True
    return out


def is_open(atoms: list[Atom]) -> bool:
    return any(a.new is None for a in atoms)


def fold(name: str) -> str:
    return _SPACE.sub(" ", re.sub(r"[^\w ]+", " ", name.lower())).strip()


def length(value: str) -> int:
    return min(100, max(1, len(value.split())))


def core(name: str) -> str:
    """A name without leading titles: words with a dot that are not initials."""
    words = name.split()
    while len(words) > 1 and re.fullmatch(r"[^\W\d]{2,5}\.", words[0]):
        words = words[1:]
    return fold(" ".join(words))


def runs(atoms: list[Atom]) -> list[list[Atom]]:
    out: list[list[Atom]] = []
    for atom in atoms:
        if atom.new is None and out:
            out[-1].append(atom)
        else:
            out.append([atom])
    return out


def joined(atoms: list[Atom]) -> str:
    """The text of atoms that are one value."""
    return atoms[0].name + "".join((", " if a.by == "," else f" {a.by} ") + a.name for a in atoms[1:])


@dataclass
class Model:
    lengths: list[float]  # share of values by number of words
    total: float
    fresh: float  # distinct values, the weight of values not seen before
    suffixes: float
    inverted: float = INVERTED
    parts: dict[str, float] = field(default_factory=dict)  # share of each open delimiter that separates

    def value(self, count: float, words: int, joint: bool = False) -> float:
        base = self.lengths[min(words, LENGTHS - 1)] * 2000.0**-words * (JOINT if joint else 1.0)
        return -math.log((count + self.fresh * base) / (self.total + self.fresh))

    def suffix(self, count: float, name: str) -> float:
        words = len(name.split())
        title = "." in name and words <= 2 and len(name) <= 9
        shape = 0.005 if title else 1e-4 if len(name) <= 4 and name.isupper() else 1e-6 * 2000.0**-words
        return -math.log((count + 20 * shape) / (self.suffixes + 20))

    def turn(self, surname: str) -> float:
        return -math.log(self.inverted * (1.0 if len(surname.split()) == 1 and "." not in surname else 0.01))

    def separates(self, by: str) -> float:
        return -math.log(self.parts.get(by, SEPARATES))

    def stays(self, by: str) -> float:
        return -math.log(1.0 - self.parts.get(by, SEPARATES))


@dataclass
class Segment:
    """One reading of atoms begin..end-1 of a run as a value: its head's key, suffix keys, whether it is inverted."""

    begin: int
    end: int
    head: str
    words: int
    suffixes: list[tuple[str, str]]  # key, name
    turned: str | None  # the surname of an inverted name
    joint: bool  # the head holds a delimiter


def segments(run: list[Atom]) -> list[Segment]:
    """The lattice of a run: a value is an atom, an inverted pair, or up to three atoms joined by other delimiters than commas,
    then suffixes behind commas. A number closes a value."""
    out = []
    n = len(run)
    closes = [a.number is not None and not a.opened for a in run]
    for i in range(n):
        heads = [(1, run[i].name, None)]
        j = i + 1
        if j < n and not closes[i] and run[j].by == "," and not run[j].opened:
            heads.append((2, run[j].name + " " + run[i].name, run[i].name))
        while j < n and j - i < 3 and not closes[j - 1] and run[j].by != "," and not run[j].opened:
            heads.append((j + 1 - i, joined(run[i : j + 1]), None))
            j += 1
        for size, text, turned in heads:
            key = core(text)
            found: list[tuple[str, str]] = []
            j = i + size
            while True:
                out.append(Segment(i, j, "n:" + key, length(key), list(found), turned, size > 1 and turned is None))
                if j >= n or run[j].opened or closes[j - 1] or run[j].by != ",":
                    break
                found.append(("s:" + fold(run[j].name), run[j].name))
                j += 1
    return out


def values(atoms: list[Atom]) -> list[str]:
    """Values that the lattice of the field needs frequencies of."""
    lattices = (segments(run) for run in runs(atoms) if len(run) > 1)
    return sorted({key for lattice in lattices for s in lattice for key in (s.head, *(k for k, _ in s.suffixes))})


def cost(run: list[Atom], s: Segment, counts: dict[str, float], model: Model) -> float:
    out = model.value(counts.get(s.head, 0.0), s.words, s.joint) + sum(model.suffix(counts.get(k, 0.0), name) for k, name in s.suffixes)
    if s.turned is not None:
        out += model.turn(s.turned)
    if s.begin:
        out += model.separates(run[s.begin].by)
    return out + sum(model.stays(run[k].by) for k in range(s.begin + 1, s.end))


def decode(atoms: list[Atom], counts: dict[str, float], model: Model) -> list[list[int]]:
    """Members as lists of atom numbers: the Viterbi path through the segments of each run."""
    out: list[list[int]] = []
    base = 0
    for run in runs(atoms):
        n = len(run)
        if n == 1:
            out.append([base])
        else:
            best: list[tuple[float, int]] = [(0.0, -1)] + [(math.inf, -1)] * n
            for s in segments(run):  # by their beginnings, so a beginning is final before it is used
                total = best[s.begin][0] + cost(run, s, counts, model)
                if total < best[s.end][0]:
                    best[s.end] = (total, s.begin)
            parts, end = [], n
            while end > 0:
                begin = best[end][1]
                parts.append([base + k for k in range(begin, end)])
                end = begin
            out += parts[::-1]
        base += n
    return out


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def expected(atoms: list[Atom], counts: dict[str, float], model: Model) -> dict[str, float]:
    """What a field teaches: expected counts of values 'n:', suffixes 's:', delimiters 'D:' and separating ones 'd:', values
    in open runs 'T:' and inverted ones 't:'."""
    out: dict[str, float] = {}

    def teach(key: str, weight: float) -> None:
        out[key] = out.get(key, 0.0) + weight

    for run in runs(atoms):
        n = len(run)
        if n == 1:
            teach("n:" + core(run[0].name), 1.0)
            continue
        priced = [(s, -cost(run, s, counts, model)) for s in segments(run)]
        ahead, behind = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for s, logp in priced:
            ahead[s.end] = _add(ahead[s.end], ahead[s.begin] + logp)
        for s, logp in reversed(priced):
            behind[s.begin] = _add(behind[s.begin], behind[s.end] + logp)
        for a in run[1:]:
            teach("D:" + a.by, 1.0)
        for s, logp in priced:
            weight = math.exp(ahead[s.begin] + logp + behind[s.end] - ahead[n])
            if weight < LEAST:
                continue
            teach(s.head, weight)
            teach("T:", weight)
            for key, _ in s.suffixes:
                teach(key, weight)
            if s.turned is not None:
                teach("t:", weight)
            if s.begin:
                teach("d:" + run[s.begin].by, weight)
    return out


def members(atoms: list[Atom], paths: list[list[int]]) -> list[tuple[int, str, str]]:
    out = []
    for k, path in enumerate(paths, 1):
        numbers = [atoms[i].number for i in path if atoms[i].number]
        out.append((k, joined([atoms[i] for i in path]), numbers[0] if numbers else ""))
    return out


def dump(atoms: list[Atom]) -> str:
    return json.dumps([[a.name, a.number, a.new, a.opened, a.by] for a in atoms])


def load(text: str) -> list[Atom]:
    return [Atom(*a) for a in json.loads(text)]


_STRINGS = T.ArrayType(T.StringType())
_MEMBERS = T.ArrayType(T.StructType([T.StructField("posisi", T.IntegerType()), T.StructField("nama", T.StringType()), T.StructField("nomor", T.StringType())]))


_TAUGHT = T.ArrayType(T.StructType([T.StructField("value", T.StringType()), T.StructField("n", T.DoubleType())]))


def _scanning(text: str, names: list[str]):
    """Rows of the members of plain fields (posisi from 1) and one row of atoms (posisi 0) for each field that is open."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, found = [], []
            for k, value in enumerate(batch[text]):
                atoms = scan(value)
                if is_open(atoms):
                    at.append(k)
                    found.append((0, "", "", dump(atoms)))
                else:
                    at += [k] * len(atoms)
                    found += [(j, a.name, a.number or "", None) for j, a in enumerate(atoms, 1)]
            out = batch[names].iloc[np.array(at, dtype=np.int64)].reset_index(drop=True)
            rows = list(zip(*found)) if found else [[]] * 4
            for name, column, kind in zip(("posisi", "nama", "nomor", "__atoms"), rows, ("int32", object, object, object)):
                out[name] = pd.Series(list(column), dtype=kind)
            yield out

    return run


def _native_core(name: Column) -> Column:
    """``core`` as a column expression."""
    bare = F.regexp_replace(name, r"(?U)^(?:[\w&&[^\d]]{2,5}\. )+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(bare), r"(?U)[^\w ]+", " "), r"(?U)\s+", " "))


@F.pandas_udf(_STRINGS)
def _lattice_values(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: values(load(t)))


def _with_counts(model: Model, what, kind: T.DataType):
    @F.pandas_udf(kind)
    def run(texts: pd.Series, found: pd.Series) -> pd.Series:
        def one(text, known):
            counts = {r["value"]: r["n"] for r in known if r["n"] is not None} if known is not None else {}
            return what(load(text), counts)

        return pd.Series([one(t, k) for t, k in zip(texts, found)])

    return run


Stats = dict[tuple[str, int, str], tuple[float, int]]


def statistics(counts: DataFrame) -> Stats:
    """Sums of ``n`` and numbers of values that are ``fresh`` by kind of value, words and delimiter: at most two dozen entries."""
    kind = F.substring("value", 1, 1)
    words = F.when(kind.isin("n", "s"), F.least(F.lit(LENGTHS - 1), F.greatest(F.lit(1), F.size(F.split("value", " "))))).otherwise(0)
    by = F.when(kind.isin("d", "D"), F.substring("value", 3, 9)).otherwise("")
    found = counts.groupBy(kind.alias("kind"), words.alias("words"), by.alias("by")).agg(F.sum("n").alias("n"), F.count_if("fresh").alias("fresh"))
    return {(r["kind"], r["words"], r["by"]): (r["n"], r["fresh"]) for r in found.collect()}


def fitted(*known: Stats) -> Model:
    """The model that counts of values, suffixes and delimiters give."""

    def get(kind: str, words: int = 0, by: str = "") -> tuple[float, int]:
        own = [s[kind, words, by] for s in known if (kind, words, by) in s]
        return sum(n for n, _ in own), sum(d for _, d in own)

    every = range(1, LENGTHS)
    total = sum(get("n", w)[0] for w in every)
    shares = [0.0] + [(get("n", w)[0] + 0.05) / (total + 0.05 * (LENGTHS - 1)) for w in every]
    # Shares that nothing is known of stay where they began.
    parts = {by: (get("d", by=by)[0] + 2 * SEPARATES) / (get("D", by=by)[0] + 2) for by in OPEN}
    inverted = (get("t")[0] + 20 * INVERTED) / (get("T")[0] + 20)
    return Model(shares, total, max(1.0, sum(get("n", w)[1] for w in every)), sum(get("s", w)[0] for w in every), inverted, parts)


def split(rows: DataFrame, text: str, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` with one row a value: ``posisi`` (from 1), ``nama``, ``nomor``; other columns stay.

    Fields that are null, blank, a stand-in for null or have no value give no row. Repeated rows are split each. Columns of
    ``rows`` named like the new ones are replaced. With an empty table, or one without any plain field, lengths fall back
    to a uniform prior. ``rounds``: the most rounds of expectation-maximisation.
    """
    keep = [c for c in rows.columns if c not in ("posisi", "nama", "nomor", text)]
    kept = [F.col(f"`{c}`") for c in keep]
    base = rows.where(F.col(f"`{text}`").isNotNull()).select(*kept, F.col(f"`{text}`").alias("__text"))
    added = [T.StructField(n, t) for n, t in (("posisi", T.IntegerType()), ("nama", T.StringType()), ("nomor", T.StringType()), ("__atoms", T.StringType()))]
    schema = T.StructType([*[base.schema[c] for c in keep], *added])
    scanned = cut(base.mapInPandas(_scanning("__text", keep), schema))  # the fields are scanned once
    sure, opened = scanned.where("posisi > 0"), scanned.where("posisi = 0")
    unclear = cut(opened.groupBy("__atoms").agg(F.count("*").alias("__times")))
    edges = cut(unclear.select("__atoms", F.explode(_lattice_values("__atoms")).alias("value")))
    often = hot_keys(edges.groupBy("value").count(), "value")
    # Of the values of plain fields, the rounds need only those that lattices ask for; all count by their lengths.
    plain = sure.groupBy(F.concat(F.lit("n:"), _native_core(F.col("nama"))).alias("value")).agg(F.count("*").cast("double").alias("n"))
    plain = cut(plain.withColumn("fresh", F.lit(True)))
    about = statistics(plain)
    asked = cut(plain.join(edges.select("value").distinct(), "value", "left_semi").select("value", "n", F.lit(False).alias("taught")))
    counts, model = asked.select("value", "n"), fitted(about)

    def known(counts: DataFrame) -> DataFrame:
        return lookup(edges, counts, "value", often, "left").groupBy("__atoms").agg(F.collect_list(F.struct("value", "n")).alias("__known"))

    for _ in range(rounds):
        teach = _with_counts(model, lambda atoms, found, model=model: list(expected(atoms, found, model).items()), _TAUGHT)
        taught = known(counts).select(F.inline(teach("__atoms", "__known"))).withColumn("taught", F.lit(True))
        # A field alone must not teach itself: of what lattices teach about a value or suffix, one field's worth is taken off.
        own, learned = (F.coalesce(F.sum(F.when(t, F.col("n"))), F.lit(0.0)) for t in (~F.col("taught"), F.col("taught")))
        shared = F.when(F.col("value").rlike("^[ns]:"), F.greatest(learned - 1.0, F.lit(0.0))).otherwise(learned)
        both = cut(asked.unionByName(taught).groupBy("value").agg(own.alias("own"), shared.alias("shared")).where("own + shared > 0"))
        counts, before = both.select("value", (F.col("own") + F.col("shared")).alias("n")), model
        model = fitted(about, statistics(both.select("value", F.col("shared").alias("n"), (F.col("own") == 0).alias("fresh"))))
        if all(abs(model.parts[by] - before.parts[by]) < STILL for by in OPEN):
            break
    choose = _with_counts(model, lambda atoms, found: members(atoms, decode(atoms, found, model)), _MEMBERS)
    decided = known(counts).select("__atoms", choose("__atoms", "__known").alias("__members"))
    placed = lookup(opened.select(*kept, "__atoms"), decided, "__atoms", hot_keys(unclear, "__atoms", "__times"))
    return sure.select(*kept, "posisi", "nama", "nomor").unionByName(placed.select(*kept, F.inline("__members")))

