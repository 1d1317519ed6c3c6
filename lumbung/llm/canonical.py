"""Free-entered values mapped to the entry of a reference list that is meant, or reported as meaning none.

Entries and their known other names become keys of a BK-tree under Levenshtein distance, a true metric: for a query and a
threshold t, the triangle inequality prunes every branch whose edge differs from the query's distance to the node by more
than t, so each search returns *every* entry within the threshold. Queries are searched in a few normal forms (wrappers
such as a faculty code or a year removed, words sorted). Shortened forms that no edit distance can tell (truncations, word
abbreviations, initialisms, item numbers) are matched on the same keys by prefix rules when exactly one entry fits.

A reference list of at most ``BROADCAST_ENTRIES`` entries is one broadcast tree; a larger one is split into shards with a tree
each, and every value meets every shard. A shard returns what each rule finds in it, at most two entries a rule; which entry is
meant is decided once, over what all shards found, so the number of shards never changes an answer.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.operators.skew import hot_keys, lookup
from lumbung.session import cut

BROADCAST_ENTRIES = 20_000
GROUP_VALUES = 50_000
NONE = 0


def normal(text: str) -> str:
    """Lower-case ASCII words; camel case and digits apart from letters become words of their own."""
    text = unicodedata.normalize("NFKD", text)
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", text)
    text = re.sub(r"(?<=[A-Za-z])(?=\d)|(?<=\d)(?=[A-Za-z])", " ", text.lower())
    return " ".join(re.findall(r"[a-z0-9]+", text))


def _places(text: str) -> dict[str, int]:
    """The places of each letter as bits."""
    where: dict[str, int] = {}
    for i, char in enumerate(text):
        where[char] = where.get(char, 0) | 1 << i
    return where


def _letters(text: str) -> int:
    """The letters of a text as bits; letters may share one."""
    out = 0
    for char in text:
        out |= 1 << (ord(char) & 63)
    return out


def distance(a: str, b: str) -> int:
    """Levenshtein distance by bit vectors of vertical differences."""
    return _distance(a, _places(b), len(b))


def _distance(a: str, where: dict[str, int], n: int) -> int:
    if not n:
        return len(a)
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    for char in a:
        match = where.get(char, 0)
        vertical = match | minus
        diagonal = (((match & plus) + plus) ^ plus) | match
        rise = minus | (~(diagonal | plus) & full)
        fall = plus & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise = (rise << 1 | 1) & full
        fall = (fall << 1) & full
        plus = fall | (~(vertical | rise) & full)
        minus = rise & vertical
    return score


class _Node:
    __slots__ = ("key", "length", "letters", "where", "branches", "farthest")

    def __init__(self, key: str):
        self.key, self.length, self.letters, self.where = key, len(key), _letters(key), _places(key)
        self.branches: dict[int, _Node] = {}
        self.farthest = 0  # the longest edge below


class BKTree:
    """Keys under Levenshtein distance; ``find`` gives every key within a radius."""

    def __init__(self, keys: Iterable[str] = ()):
        self.root: _Node | None = None
        for key in keys:
            self.add(key)

    def add(self, key: str) -> None:
        if self.root is None:
            self.root = _Node(key)
            return
        node = self.root
        while (d := _distance(key, node.where, node.length)) != 0:
            node.farthest = max(node.farthest, d)
            if d not in node.branches:
                node.branches[d] = _Node(key)
                return
            node = node.branches[d]

    def find(self, query: str, radius: int) -> list[tuple[int, str]]:
        """Every key within the radius. A node that is surely farther than the radius and its longest edge, by length or by
        letters that only one text has, is left with its branches before its distance is computed."""
        out: list[tuple[int, str]] = []
        stack = [self.root] if self.root else []
        n, letters = len(query), _letters(query)
        while stack:
            node = stack.pop()
            far = radius + node.farthest
            if abs(node.length - n) > far or (letters & ~node.letters).bit_count() > far or (node.letters & ~letters).bit_count() > far:
                continue
            d = _distance(query, node.where, node.length)
            if d <= radius:
                out.append((d, node.key))
            stack += [child for edge, child in node.branches.items() if d - radius <= edge <= d + radius]
        return out


@dataclass
class Rules:
    """What a column's values look like beside the entry itself."""

    wrappers: tuple[str, ...] = ()  # patterns on the normal form that are cut away
    numbered: str | None = None  # pattern on the normal form whose group is the entry's number
    number: str | None = None  # pattern on the entry's normal form whose group is its number
    initials: bool = False  # codes made of letters of the words stand for entries
    rewrites: tuple[tuple[str, str], ...] = ()  # on the normal form, before all else
    aliases: dict[str, str] = field(default_factory=dict)  # other name -> entry


class Found(NamedTuple):
    """An entry that a rule finds for a value, in one shard of the entries."""

    rule: str
    form: int  # which normal form of the value
    entry: int
    cost: float


def forms_of(value: str, rules: Rules) -> list[str]:
    """The normal form of a value and what is left of it without each wrapper."""
    text = normal(value)
    for pattern, to in rules.rewrites:
        text = re.sub(pattern, to, text).strip()
    forms = [text]
    for pattern in rules.wrappers:
        cut_text = re.sub(pattern, "", forms[-1]).strip()
        if cut_text and cut_text != forms[-1]:
            forms.append(cut_text)
    return forms


def number_of(text: str, rules: Rules) -> tuple[str, str] | None:
    """The entry number that a normal form begins with, and the rest."""
    if rules.numbered and (m := re.match(rules.numbered, text)):
        return next(g for g in m.groups() if g), text.replace(m[0], "", 1).strip()
    return None


def decide(value: str, found: Iterable[Found], rules: Rules) -> tuple[int, float]:
    """Entry and cost by what all shards found: a rule that needs a single entry looks at the entries of all of them."""
    by_rule: dict[tuple[str, int], list[Found]] = {}
    for f in found:
        by_rule.setdefault((f.rule, f.form), []).append(f)

    def single(rule: str, form: int) -> int | None:
        entries = {f.entry for f in by_rule.get((rule, form), ())}
        return entries.pop() if len(entries) == 1 else None

    if exact := by_rule.get(("exact", 0)):
        return min(f.entry for f in exact), 0.0
    forms = forms_of(value, rules)
    if number_of(forms[0], rules):
        numbered = by_rule.get(("number", 0), [])
        if not numbered:
            return NONE, 9.0
        if fitting := [f.entry for f in numbered if f.cost < 1]:
            return min(fitting), 0.5
    near = by_rule.get(("near", 0), [])
    least = min((f.cost for f in near), default=9.0)
    nearest = {f.entry for f in near if f.cost <= least + 1e-9}
    if len(nearest) == 1 and least == 0:
        return nearest.pop(), 0.0
    for form in range(len(forms)):  # a truncation of one entry only is none of another
        if (k := single("begun", form)) is not None:
            return k, 0.5
    if len(nearest) == 1:
        return nearest.pop(), least
    for form in reversed(range(len(forms))):
        for rule in ("short", "prefix"):
            if (k := single(rule, form)) is not None:
                return k, 0.5
        if ("prefix", form) in by_rule and (k := single("prefix of as many words", form)) is not None:
            return k, 0.5
        codes = sorted((f.cost, f.entry) for f in by_rule.get(("code", form), ()))
        if codes and (len(codes) == 1 or codes[0][0] < codes[1][0]):
            return codes[0][1], 0.5
    return NONE, 9.0


class Matcher:
    """Finds entries for a value among (a shard of) the entries ``{id: name}``.

    Beside the tree, sorted names and small dictionaries answer the rules for shortened forms, so no rule looks at all
    entries. Of each rule the best two entries are enough to decide, whatever the other shards hold.
    """

    def __init__(self, entries: dict[int, str], rules: Rules):
        self.rules = rules
        self.known: dict[str, tuple[int, float]] = {}
        self.ids: dict[str, set[int]] = {}
        self.exact: dict[str, int] = {}
        self.names: dict[int, list[str]] = {}
        self.short: dict[str, set[int]] = {}
        self.numbers: dict[str, set[int]] = {}
        by_name: dict[str, set[int]] = {}
        for k, name in entries.items():
            self.exact[name] = min(k, self.exact.get(name, k))
            by_name.setdefault(normal(name), set()).add(k)
            bare = re.sub(r"\s*\(([^)]*)\)", "", name)
            if (m := re.search(r"\(([^)]*)\)", name)) is not None:
                self.short.setdefault(normal(m[1]).replace(" ", ""), set()).add(k)
            self._key(normal(name), k)
            self._key(normal(bare), k)
            self.names[k] = [normal(bare)]
            if rules.number and (m := re.match(rules.number, normal(name))):
                self.numbers.setdefault(m[1], set()).add(k)
                rest = normal(name)[m.end() :].strip()
                self._key(rest, k)
                self.names[k].append(rest)
        for alias, name in rules.aliases.items():
            for k in by_name.get(normal(name), ()):
                self._key(normal(alias), k)
                self.names[k].append(normal(alias))
        self.tree = BKTree(self.ids)
        self.sorted = sorted((n, k) for k, names in self.names.items() for n in names if n)
        self.heads: dict[tuple[str, ...], list[tuple[list[str], int]]] = {}
        self.initials: dict[str, set[int]] = {}
        self.pairs: dict[tuple[str, str], set[int]] = {}
        for k, names in self.names.items():
            for n in names:
                self.heads.setdefault(tuple(w[:2] for w in n.split()), []).append((n.split(), k))
            words = names[0].split()
            self.initials.setdefault("".join(w[0] for w in words), set()).add(k)
            if len(words) == 2:
                self.pairs.setdefault((words[0][0], words[1][0]), set()).add(k)

    def _key(self, key: str, entry: int) -> None:
        for form in {key, " ".join(sorted(key.split())), key.replace(" ", "")}:
            if form:
                self.ids.setdefault(form, set()).add(entry)

    def match(self, value: str) -> tuple[int, float]:
        """Entry and cost where this matcher holds all entries."""
        if value not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[value] = decide(value, self.find(value, whole=True), self.rules)
        return self.known[value]

    def find(self, value: str, whole: bool = False) -> list[Found]:
        """What each rule finds here, at most the best two entries of each rule and form. Where the matcher holds the whole list,
        the rules that come after the deciding one are left out."""
        out: list[Found] = []

        def add(rule: str, form: int, costs: dict[int, float]) -> None:
            out.extend(Found(rule, form, k, c) for c, k in sorted((c, k) for k, c in costs.items())[:2])

        if (k := self.exact.get(value)) is not None:
            return [Found("exact", 0, k, 0.0)]
        forms = forms_of(value, self.rules)
        if numbered := number_of(forms[0], self.rules):
            number, rest = numbered
            fits = {k: 0.5 if not rest or distance(rest, self.names[k][-1]) <= 0.6 * len(rest) or k in self._prefixed(rest) else 9.0 for k in self.numbers.get(number, ())}
            add("number", 0, fits)
        near: dict[int, float] = {}
        asked = [query for form in forms for query in {form, " ".join(sorted(form.split())), form.replace(" ", "")}]
        if whole and not numbered:
            equal = {k for query in asked for k in self.ids.get(query, ())}  # a distance of 0 needs no search
            if len(equal) == 1:
                return [Found("near", 0, equal.pop(), 0.0)]
        for query in asked:
            for d, key in self.tree.find(query, self._radius(query)):
                cost = d / max(len(query), len(key), 1)
                for k in self.ids[key]:
                    near[k] = min(cost, near.get(k, 9.0))
        add("near", 0, near)
        for at, form in enumerate(forms):
            if len(form) >= 8:
                add("begun", at, dict.fromkeys(self._begun(form, 2), 0.5))
        if whole and decide(value, out, self.rules)[0] != NONE:
            return out
        for at, form in enumerate(forms):
            add("short", at, dict.fromkeys(self.short.get(form.replace(" ", ""), ()), 0.5))
            hits = self._prefixed(form)
            add("prefix", at, dict.fromkeys(hits, 0.5))
            words = len(form.split())
            add("prefix of as many words", at, {k: 0.5 for k in hits if any(len(n.split()) == words for n in self.names[k])})
            if self.rules.initials and re.fullmatch(r"[a-z]{2,6}", form):
                add("code", at, self._codes(form))
        return out

    @staticmethod
    def _radius(query: str) -> int:
        return 0 if len(query) < 5 else max(1, round(len(query) * 0.2))

    def _begun(self, form: str, most: int | None = None) -> dict[int, list[str]]:
        """Entries with the names that begin with ``form``; the first ``most`` entries are enough to tell one from several."""
        out: dict[int, list[str]] = {}
        for at in range(bisect_left(self.sorted, (form,)), len(self.sorted)):
            name, k = self.sorted[at]
            if not name.startswith(form) or most is not None and len(out) == most:
                break
            out.setdefault(k, []).append(name)
        return out

    def _prefixed(self, form: str) -> set[int]:
        """Entries whose words the form's words are beginnings of, in order; the last entry words may lack if it is a truncation."""
        words = form.split()
        if len(form.replace(" ", "")) < 6:
            return set()
        out = {k for k, names in self._begun(form).items() if any(form != n and len(form) >= 0.5 * len(n) for n in names)}
        if all(len(w) > 1 for w in words):
            out |= {k for parts, k in self.heads.get(tuple(w[:2] for w in words), ()) if all(p.startswith(w) for w, p in zip(words, parts))}
        return out

    def _codes(self, code: str) -> dict[int, float]:
        """Entries whose letters a code can be, with how well it stands for them."""
        out = dict.fromkeys(self.initials.get(code, ()), 0.0)
        if len(code) == 3:
            for k in self.pairs.get((code[0], code[1]), set()) | self.pairs.get((code[0], code[2]), set()):
                if k not in out and (cost := self._code(code, *self.names[k][0].split())) < 9:
                    out[k] = cost
        return out

    @staticmethod
    def _code(code: str, a: str, b: str) -> float:
        """Three letters of two words that begin with both initials: the nearer to their beginnings, the better."""
        if code == a[:2] + b[0]:
            return 1.0
        for lead in (1, 2):
            if a[0] == code[0] and b[0] == code[lead]:
                rest = code[1] if lead == 2 else code[2]
                tail = a[1:] if lead == 2 else b[1:]
                if rest in tail:
                    consonants = re.sub("[aeiou]", "", tail)
                    return 1.2 if consonants[:1] == rest or tail[:1] == rest else 1.5
        return 9.0


_MATCHERS: dict[str, Matcher] = {}


def _matcher(broadcast) -> Matcher:
    key, entries, rules = broadcast.value
    if key not in _MATCHERS:
        if len(_MATCHERS) > 16:
            _MATCHERS.clear()
        _MATCHERS[key] = Matcher(entries, rules)
    return _MATCHERS[key]


_FOUND = T.StructType([T.StructField("ref_id", T.IntegerType()), T.StructField("biaya", T.DoubleType())])


def _match_udf(broadcast):
    @F.pandas_udf(_FOUND)
    def run(values: pd.Series) -> pd.DataFrame:
        matcher = _matcher(broadcast)
        found = [matcher.match(v) if isinstance(v, str) else (None, None) for v in values]
        return pd.DataFrame({"ref_id": pd.array([f[0] for f in found], "Int32"), "biaya": [f[1] for f in found]})

    return run


def _decide_udf(rules: Rules):
    @F.pandas_udf(_FOUND)
    def run(values: pd.Series, found: pd.Series) -> pd.DataFrame:
        decided = [decide(v, [Found(**f) for f in fs], rules) for v, fs in zip(values, found)]
        return pd.DataFrame(decided, columns=["ref_id", "biaya"])

    return run


def mapped(
    values: DataFrame, column: str, reference: DataFrame, key: str, name: str, rules: Rules, shards: int | None = None, group: int = GROUP_VALUES
) -> DataFrame:
    """``values`` with ``ref_id`` (the entry's key, 0 if none is meant, null for a null value) and ``biaya`` (its cost).

    Null names of the reference are no entries; an empty reference maps everything to 0. Repeated rows stay repeated, columns
    named like the new ones are replaced. ``shards``: None chooses one broadcast tree or shards by the counted entries; the
    result is the same. A group of the sharded search holds about ``group`` distinct values and the entries of one shard.
    """
    base = values.drop("ref_id", "biaya")
    # Equal values are searched once; the rows of values that hold more than a hundredth of all rows never shuffle.
    counted = cut(base.select(F.col(column).alias("v")).where(F.col("v").isNotNull()).groupBy("v").count())
    found = decided(counted, reference, key, name, rules, shards, group).withColumnRenamed("v", column)
    out = lookup(base, found, column, hot_keys(counted, "v"), "left")
    some = F.col(column).isNotNull()
    return out.select(
        *[F.col(f"`{c}`") for c in base.columns],
        F.coalesce("__found.ref_id", F.when(some, F.lit(NONE))).alias("ref_id"),
        F.coalesce("__found.biaya", F.when(some, F.lit(9.0))).alias("biaya"),
    )


def decided(counted: DataFrame, reference: DataFrame, key: str, name: str, rules: Rules, shards: int | None = None, group: int = GROUP_VALUES) -> DataFrame:
    """(v, __found) of the distinct values ``v`` of a checkpointed frame: __found has ref_id and biaya."""
    spark = counted.sparkSession
    entries = reference.where(F.col(name).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("int").alias("k"), F.col(name).alias("n"))
    if shards is None:
        shards = -(-entries.count() // BROADCAST_ENTRIES)
    if shards > 1:
        return _sharded(counted, entries, rules, shards, group)
    listed = {r.k: r.n for r in entries.orderBy("k").collect()}  # at most BROADCAST_ENTRIES
    broadcast = spark.sparkContext.broadcast((uuid.uuid4().hex, listed, rules))
    # An own number of partitions: the values are small in bytes but not in work, so AQE must not join their partitions.
    spread = counted.select("v").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "v")
    return spread.select("v", _match_udf(broadcast)("v").alias("__found"))


def _sharded(counted: DataFrame, entries: DataFrame, rules: Rules, shards: int, group: int) -> DataFrame:
    """(v, __found): every value meets every shard of the entries, and what they find is decided together."""

    def shard(_, texts: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        matcher = Matcher(dict(zip(part["k"], part["n"])), rules)
        rows = [(v, *f) for v in texts["v"] for f in matcher.find(v)]
        return pd.DataFrame(rows, columns=["v", "rule", "form", "entry", "cost"])

    salts = max(1, -(-counted.count() // group))
    spread = counted.select("v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.hash("v"), F.lit(salts)).alias("salt"))
    parts = entries.withColumn("shard", F.pmod(F.hash("k"), F.lit(shards))).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = spread.groupBy("shard", "salt").cogroup(parts.groupBy("shard", "salt")).applyInPandas(shard, "v string, rule string, form int, entry int, cost double")
    # At most two entries a rule, form and shard: what a value's group holds is bounded by the number of shards.
    found = found.groupBy("v").agg(F.collect_list(F.struct("rule", "form", "entry", "cost")).alias("__all"))
    return found.select("v", _decide_udf(rules)("v", "__all").alias("__found"))
