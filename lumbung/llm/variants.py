"""Variant spellings of names typed by people, linked to the entity they mean.

Names become character-trigram vectors weighted by inverse document frequency, and a sparse similarity join gives every pair
of a name and an entity whose cosine reaches the threshold, with no cap on partners: entities are cut into blocks of at most
``BLOCK``, names into groups of about ``GROUP``, and a task multiplies one group with one block through the block's inverted
index of trigrams, touching only entities that share a trigram with the name. The pairs are then checked word by word (typos,
initials, nicknames, moved, merged, split and dropped words), best cosine first, as far as they can still rival the best one.

Groups grow by average linkage: every entity is a cluster with its undisputed variants, clusters never merge, and a
disputed variant joins the cluster whose members are on average most similar to it. The average is the product with the sum
of the members' unit vectors, so no pairs of members are formed however large a cluster is.

Names that no entity claims are grouped among themselves by average-linkage clustering (``grouped``).

Only the trigram weights (at most 28**3 entries) and the nicknames (a bounded list) are broadcast.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lumbung.operators.skew import hot_keys, lookup
from lumbung.session import cut

COSINE = 0.38
MAX_COST = 2.6
DISPUTED = 0.3
LINKAGE = 0.6
BLOCK = 32_768
GROUP = 4_000

# Words that stand for titles and degrees, without dots.
TITLES = frozenset(
    """
    prof dr drs dra ir apt h hj eng med vet ns ners kh ust phd mphil md mba
    sp ssi st se sh skom sked sfarm spd ssos sag sip sds sn ssn sgz skep skm spt spi sik amd
    msi mt mm mh mkom mkes mpd msc meng mag ma mp mhum mds msn mfarm mgz mkep mt mep map mak
    """.split()
)
BARE_TITLES = frozenset(("prof", "dr", "drs", "dra", "ir", "apt", "phd", "eng"))  # also without a dot
# Old and foreign spellings of Indonesian sounds, in the order of replacement.
SOUNDS = (("oe", "u"), ("tj", "c"), ("dj", "j"), ("nj", "ny"), ("sj", "sy"), ("ch", "kh"), ("j", "y"), ("q", "k"), ("x", "ks"), ("v", "f"), ("z", "s"))


def read(name: str | None) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Name words in lower-case ASCII, an inverted name turned round, and the titles apart from them."""
    if not name:
        return (), ()
    text = unicodedata.normalize("NFKD", name.replace("\u00a0", " "))
    text = "".join(c for c in text if not unicodedata.combining(c)).lower()
    parts, titles = [], set()
    for part in text.split(","):
        tokens = [t for t in re.split(r"[\s_]+", re.sub(r"[-/]", " ", part)) if t]
        kept = []
        for token in tokens:
            plain = re.sub(r"[^a-z]", "", token)
            if not plain:
                continue
            if plain in TITLES and len(plain) > 1 and ("." in token or plain in BARE_TITLES):
                titles.add(plain)
                continue
            kept.append(plain)
        if kept:
            parts.append(kept)
    if len(parts) > 1:
        parts = parts[1:] + parts[:1]
    return tuple(w for p in parts for w in p), tuple(sorted(titles))


def words_of(name: str | None) -> tuple[str, ...]:
    return read(name)[0]


@lru_cache(maxsize=200_000)
def sound(word: str) -> str:
    for a, b in SOUNDS:
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


@lru_cache(maxsize=500_000)
def edits(a: str, b: str) -> int:
    """Restricted Damerau-Levenshtein distance."""
    if a == b:
        return 0
    before, prev, cur = [], list(range(len(b) + 1)), []
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            best = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            cur.append(best)
        before, prev = prev, cur
    return prev[-1]


def _odd_letters(a: str, b: str) -> int:
    """Lower bound of the edits between two words by the letters they do not share."""
    rest = list(b)
    extra = 0
    for char in a:
        if char in rest:
            rest.remove(char)
        else:
            extra += 1
    return max(extra, len(rest))


@lru_cache(maxsize=500_000)
def _letters(word: str) -> int:
    """The letters of a word as bits."""
    return reduce(or_, (1 << (ord(c) & 31) for c in word), 0)


def _may_be_within(a: str, b: str, most: int) -> bool:
    """False only for words of more edits: first by the letters that occur in one alone, then by how often."""
    x, y = _letters(a), _letters(b)
    return (x & ~y).bit_count() <= most and (y & ~x).bit_count() <= most and _odd_letters(a, b) <= most


class Aligner:
    """Least cost of writing one name as another, word by word; remembers the costs of pairs of words."""

    def __init__(self, nicknames: dict[str, frozenset[str]]):
        self.nicknames = nicknames
        self.costs: dict[tuple[str, str], float | None] = {}

    def word(self, typed: str, word: str) -> float | None:
        """Cost of writing ``word`` as ``typed``; None if it isn't plausible."""
        if typed == word:
            return 0.0
        if len(typed) == 1:
            return 1.0 if word[0] == typed else None
        pair = (typed, word)
        if pair not in self.costs:
            if len(self.costs) > 500_000:
                self.costs.clear()
            self.costs[pair] = self._word(typed, word)
        return self.costs[pair]

    def _word(self, typed: str, word: str) -> float | None:
        if word in self.nicknames.get(typed, ()):
            return 0.5
        heard, meant = sound(typed), sound(word)
        if heard == meant:
            return 0.3
        short, long = sorted((len(typed), len(word)))
        if long - short <= 2:
            most = 1 if short <= 4 else 2 if short <= 8 else 3
            for a, b in ((heard, meant), (typed, word)):
                if _may_be_within(a, b, most) and (d := edits(a, b)) <= most:
                    return 0.7 * min(d, edits(typed, word))
        if 3 <= len(typed) < len(word):
            if word.startswith(typed) or word.endswith(typed):
                return 1.2
            if len(typed) >= 4 and typed[:2] == word[:2]:
                for k in range(2, len(typed)):
                    if word.startswith(typed[:k]) and (word.endswith(typed[k:]) or typed[k:] in ("to", "i", "o")):
                        return 1.5
        return None

    def name(self, typed: tuple[str, ...], words: tuple[str, ...], limit: float = MAX_COST) -> float | None:
        """Least cost of writing the name ``words`` as ``typed``, None above the limit: words may move, merge, split or be left
        out; every typed word must stand for something."""
        least: float | None = None
        n = len(words)
        stack = [(0, 0, 0.0, 0)]
        while stack:
            i, used, cost, solid = stack.pop()
            if least is not None and cost >= least:
                continue
            if i == len(typed):
                left = n - used.bit_count()
                if left:
                    if solid < 2 or left > 2 or left >= n - 1:
                        continue
                    cost += 1.4 * left
                if cost <= limit and (least is None or cost < least):
                    least = cost
                continue
            t = typed[i]
            place = used.bit_count()
            for k in range(n):
                if used >> k & 1:
                    continue
                c = self.word(t, words[k])
                if c is not None and cost + c <= limit:
                    stack.append((i + 1, used | 1 << k, cost + c + (0.0 if k == place else 0.15), solid + (len(t) > 1)))
                if len(t) > 6 and k + 1 < n and not used >> (k + 1) & 1:
                    both = words[k] + words[k + 1]
                    if abs(len(t) - len(both)) <= 2 and t[0] == both[0]:
                        c = self.word(t, both)
                        if c is not None and c < 1.5:
                            stack.append((i + 1, used | 3 << k, cost + c + 0.4, solid + 2))
                if i + 1 < len(typed) and len(t) > 1 and abs(len(t) + len(typed[i + 1]) - len(words[k])) <= 1:
                    c = self.word(t + typed[i + 1], words[k])
                    if c is not None and c < 1.2:
                        stack.append((i + 2, used | 1 << k, cost + c + 0.4, solid + 1))
        return least


@lru_cache(maxsize=200_000)
def grams(name: str) -> tuple[str, ...]:
    padded = f" {sound(name)} "
    return tuple(sorted({padded[i : i + 3] for i in range(len(padded) - 2)}))


class Block:
    """Inverted index of the trigrams of some entities."""

    def __init__(self, cores: list[str], places: dict[str, int], squares: np.ndarray):
        self.cores, self.places, self.squares = cores, places, squares
        vectors = [self._vector(c) for c in cores]
        sizes = [len(v) for v in vectors]
        flat = np.concatenate(vectors) if vectors else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(cores), dtype=np.int64), sizes)
        order = np.argsort(flat, kind="stable")
        self.postings = np.split(owner[order], np.searchsorted(flat[order], np.arange(1, len(squares))))
        self.norms = np.sqrt(np.bincount(owner, weights=squares[flat], minlength=len(cores)))

    def _vector(self, core: str) -> np.ndarray:
        return np.fromiter((self.places[g] for g in grams(core)), np.int64)

    def near(self, core: str, cosine: float = COSINE) -> list[tuple[float, str]]:
        """Every entity of at least the cosine, the most similar first."""
        vector = self._vector(core)
        lists = [self.postings[g] for g in vector]
        weights = np.repeat(self.squares[vector], [len(x) for x in lists])
        products = np.bincount(np.concatenate(lists), weights=weights, minlength=len(self.cores))
        norm = math.sqrt(self.squares[vector].sum())
        hits = np.flatnonzero(products >= cosine * norm * self.norms)
        return sorted(((products[k] / (norm * self.norms[k]), self.cores[k]) for k in hits), key=lambda x: (-x[0], x[1]))


def rivals(core: str, near: list[tuple[float, str]], align: Aligner) -> list[tuple[str, float, float]]:
    """Entities that the word check accepts, as (entity, cosine, cost), as far as they rival the least cost."""
    typed, limit, out = tuple(core.split()), MAX_COST, []
    for cosine, entity in near:
        cost = align.name(typed, tuple(entity.split()), limit)
        if cost is not None:
            out.append((entity, cosine, cost))
            limit = min(limit, cost + DISPUTED)
    return [r for r in out if r[2] <= limit]


_READ = T.StructType([T.StructField("core", T.StringType()), T.StructField("titles", T.StringType())])


@F.pandas_udf(_READ)
def _read(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(" ".join(w), " ".join(t)) for w, t in map(read, names)], columns=["core", "titles"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _grams(cores: pd.Series) -> pd.Series:
    return cores.map(grams)


_KNOWN: dict[str, tuple[dict, np.ndarray, Aligner, dict[int, Block]]] = {}


def _known(broadcast) -> tuple[dict, np.ndarray, Aligner, dict[int, Block]]:
    """Weights, aligner and blocks of a Python worker for one run of ``link``."""
    run, squares, nicknames = broadcast.value
    if run not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[run] = ({g: k for k, g in enumerate(squares)}, np.fromiter(squares.values(), float), Aligner(nicknames), {})
    return _KNOWN[run]


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _multiplied(rest: DataFrame, known: DataFrame, shared, work, schema: str) -> DataFrame:
    """Every group of names (``__core``) against every block of entities (``__entity_core``): rows of ``work(core, block)``."""
    blocks = max(1, -(-known.count() // BLOCK))
    groups = max(1, -(-rest.count() // GROUP))
    names = [c.split()[0] for c in schema.split(", ")]

    def multiply(key: tuple, cores: pd.DataFrame, entities: pd.DataFrame) -> pd.DataFrame:
        places, squares, _, built = _known(shared)
        if key[0] not in built:
            built[key[0]] = Block(sorted(entities["__entity_core"]), places, squares)
        block = built[key[0]]
        return pd.DataFrame([(core, *r) for core in cores["__core"] for r in (work(core, block) if block.cores else ())], columns=names)

    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    asking = rest.select("__core", F.pmod(F.xxhash64("__core"), F.lit(groups)).alias("__group"), every(blocks).alias("__block"))
    index = known.select("__entity_core", F.pmod(F.xxhash64("__entity_core"), F.lit(blocks)).alias("__block"), every(groups).alias("__group"))
    # An own number of partitions: the rows are small in bytes but not in work, so AQE must not join their partitions.
    parts = max(_parts(rest), min(blocks * groups, 10_000))
    sides = [df.repartition(parts, "__block", "__group").groupBy("__block", "__group") for df in (asking, index)]
    return sides[0].cogroup(sides[1]).applyInPandas(multiply, schema)


def _joined(rest: DataFrame, known: DataFrame, shared) -> DataFrame:
    """The similarity join: (__core, __entity_core, __cosine, __cost) of each name's rivals in each block."""
    work = lambda core, block: rivals(core, block.near(core), _known(shared)[2])
    return _multiplied(rest, known, shared, work, "__core string, __entity_core string, __cosine double, __cost double")


def _similar(cores: DataFrame, shared, cosine: float) -> DataFrame:
    """All pairs (__core < __entity_core) of names of at least the cosine."""
    work = lambda core, block: [(other, c) for c, other in block.near(core, cosine) if core < other]
    return _multiplied(cores, cores.withColumnRenamed("__core", "__entity_core"), shared, work, "__core string, __entity_core string, __cosine double")


def _unit_vectors(rows: DataFrame, core: str, shared, *keep: str) -> DataFrame:
    """One row a trigram: its weight in the unit vector of ``core``."""

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("gram", T.StringType()), T.StructField("weight", T.DoubleType())])))
    def vector(cores: pd.Series) -> pd.Series:
        places, squares, _, _ = _known(shared)

        def of(name: str) -> list[tuple[str, float]]:
            weights = [float(squares[places[g]]) for g in grams(name)]
            norm = math.sqrt(sum(weights)) or 1.0
            return [(g, math.sqrt(w) / norm) for g, w in zip(grams(name), weights)]

        return cores.map(of)

    return rows.select(*keep, F.inline(vector(core)))


def _linkage(disputed: DataFrame, members: DataFrame, shared) -> DataFrame:
    """Mean cosine of each disputed name to the members of each cluster that wants it."""
    size = members.groupBy("__entity_core").agg(F.count("*").alias("__size"))
    centre = _unit_vectors(members, "__member", shared, "__entity_core").groupBy("__entity_core", "gram").agg(F.sum("weight").alias("__sum"))
    asked = _unit_vectors(disputed, "__core", shared, "__core", "__entity_core", "__cost")
    product = asked.join(centre, ["__entity_core", "gram"]).groupBy("__core", "__entity_core", "__cost").agg(F.sum(F.col("weight") * F.col("__sum")).alias("__product"))
    return product.join(size, "__entity_core").withColumn("__linkage", F.col("__product") / F.col("__size"))


def _shared(cores: DataFrame, nicknames: dict[str, frozenset[str]]):
    """Broadcast of the trigrams' squared weights by inverse document frequency, under a name of this run, and the nicknames."""
    frequency = cores.select(F.explode(_grams("__core")).alias("gram")).groupBy("gram").count().orderBy("gram").collect()  # at most 28**3
    n = sum(r["count"] for r in frequency)
    squares = {r["gram"]: math.log(1 + n / (1 + r["count"])) ** 2 for r in frequency}
    return cores.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, squares, nicknames))


def link(names: DataFrame, name: str, entities: DataFrame, entity: str, entity_name: str, nicknames: dict[str, frozenset[str]]) -> DataFrame:
    """Distinct ``names`` that mean an entity, as (name, entity).

    ``names`` holds distinct spellings. Null, empty and title-only names and those like no entity give no row. Of several
    entities whose names are equal but for titles, the one with the same titles is taken, else the smallest key.
    ``nicknames`` maps a nickname to official words.
    """
    mentioned = cut(names.where(F.col(name).isNotNull()).select(F.col(name), _read(name).alias("__r")).select(name, F.col("__r.core").alias("__core"), F.col("__r.titles").alias("__titles")).where("__core <> ''"))
    listed = entities.where(F.col(entity_name).isNotNull() & F.col(entity).isNotNull()).select(F.col(entity).alias("__entity"), _read(entity_name).alias("__r"))
    listed = cut(listed.select("__entity", F.col("__r.core").alias("__entity_core"), F.col("__r.titles").alias("__titles")).where("__entity_core <> ''"))
    known = cut(listed.groupBy("__entity_core").agg(F.min("__entity").alias("__least_entity"), F.count("*").alias("__namesakes")))
    cores = mentioned.select("__core").distinct()
    equal = F.col("__core") == F.col("__entity_core")
    same = cores.join(known, equal).select("__core", "__entity_core")
    rest = cut(cores.join(known, equal, "left_anti"))
    shared = _shared(rest.unionByName(known.select(F.col("__entity_core").alias("__core"))), nicknames)
    scored = _joined(rest, known.select("__entity_core"), shared)
    # A name's rivals of all blocks; they are few, since each costs hardly more than the least.
    every = Window.partitionBy("__core")
    near = scored.withColumn("__cheapest", F.min("__cost").over(every)).where(F.col("__cost") <= F.col("__cheapest") + DISPUTED)
    near = cut(near.withColumn("__rivals", F.count("*").over(every)))
    sure = near.where("__rivals = 1").select("__core", "__entity_core")
    disputed = near.where("__rivals > 1").select("__core", "__entity_core", "__cost")
    own = F.col("__entity_core").alias("__member")
    members = sure.unionByName(same).select(F.col("__core").alias("__member"), "__entity_core").unionByName(known.select(own, "__entity_core"))
    members = members.join(disputed.select("__entity_core").distinct(), "__entity_core", "left_semi").distinct()
    linkage = _linkage(disputed, members, shared)
    settled = linkage.groupBy("__core").agg(F.min_by("__entity_core", F.struct(0.2 * F.col("__cost") - F.col("__linkage"), F.col("__entity_core"))).alias("__entity_core"))
    linked = same.unionByName(sure).unionByName(settled)
    out = mentioned.join(linked, "__core").join(known, "__entity_core")
    if not known.where("__namesakes > 1").head(1):
        return out.select(name, F.col("__least_entity").alias(entity))
    titled = listed.join(known.where("__namesakes > 1").select("__entity_core"), "__entity_core", "left_semi")
    titled = titled.groupBy("__entity_core", "__titles").agg(F.min("__entity").alias("__titled"))
    return out.join(titled, ["__entity_core", "__titles"], "left").select(name, F.coalesce("__titled", "__least_entity").alias(entity))


def mentions_linked(mentions: DataFrame, name: str, entities: DataFrame, entity: str, entity_name: str, nicknames) -> DataFrame:
    """Rows of ``mentions`` that mean an entity but write its name otherwise, with the entity's key.

    A mention written exactly as an entity is named means that one and gives no row. Equal spellings are linked once; the rows
    of spellings that hold more than a hundredth of all rows never shuffle.
    """
    counted = cut(mentions.where(F.col(name).isNotNull()).groupBy(name).count())
    exact = entities.where(F.col(entity_name).isNotNull()).select(F.col(entity_name).alias(name)).distinct()
    linked = link(counted.select(name), name, entities, entity, entity_name, nicknames).join(exact, name, "left_anti")
    return lookup(mentions.where(F.col(name).isNotNull()), linked, name, hot_keys(counted, name))


def grouped(names: DataFrame, name: str, linkage: float = LINKAGE) -> DataFrame:
    """Distinct ``names`` with ``kelompok``: groups of spellings by average-linkage clustering, named by their least core.

    The similarity join gives all pairs of at least ``linkage``; two clusters whose mean cosine reaches it have at least one such
    pair, so no merge is missed. Each round merges all clusters that are each other's best (the order of such merges never
    changes an average-linkage tree), and ends when no mean reaches the threshold. Means come from sums of unit vectors.
    Null, empty and title-only names give no row.
    """
    read_names = names.where(F.col(name).isNotNull()).select(name, _read(name).alias("__r")).select(name, F.col("__r.core").alias("__core")).where("__core <> ''")
    read_names = cut(read_names)
    cores = cut(read_names.select("__core").distinct())
    shared = _shared(cores, {})
    pairs = cut(_similar(cores, shared, linkage).select(F.col("__core").alias("__a"), F.col("__entity_core").alias("__b")))
    vectors = cut(_unit_vectors(cores, "__core", shared, "__core"))
    clusters = cores.select("__core", F.col("__core").alias("kelompok"))
    while True:
        of = lambda side: clusters.select(F.col("__core").alias(side), F.col("kelompok").alias(f"{side}c"))  # noqa: B023, E731
        wanted = pairs.join(of("__a"), "__a").join(of("__b"), "__b").where("__ac <> __bc")
        wanted = wanted.select(F.least("__ac", "__bc").alias("__x"), F.greatest("__ac", "__bc").alias("__y")).distinct()
        size = clusters.groupBy("kelompok").agg(F.count("*").alias("n"))
        sums = vectors.join(clusters, "__core").groupBy("kelompok", "gram").agg(F.sum("weight").alias("w"))
        one = lambda side: sums.select(F.col("kelompok").alias(side), "gram", F.col("w").alias(f"w{side}"))  # noqa: B023, E731
        product = wanted.join(one("__x"), "__x").join(one("__y"), ["__y", "gram"]).groupBy("__x", "__y").agg(F.sum(F.col("w__x") * F.col("w__y")).alias("p"))
        sized = product.join(size.withColumnsRenamed({"kelompok": "__x", "n": "nx"}), "__x").join(size.withColumnsRenamed({"kelompok": "__y", "n": "ny"}), "__y")
        close = sized.select("__x", "__y", F.round(F.col("p") / (F.col("nx") * F.col("ny")), 12).alias("mean")).where(F.col("mean") >= linkage)
        pair = F.struct("mean", "__x", "__y")
        best = close.select(F.explode(F.array("__x", "__y")).alias("c"), pair.alias("pair")).groupBy("c").agg(F.max("pair").alias("pair"))
        merged = cut(best.groupBy("pair").agg(F.count("*").alias("k")).where("k = 2").select(F.col("pair.__y").alias("kelompok"), F.col("pair.__x").alias("__into")))
        if not merged.head(1):
            return read_names.join(clusters, "__core").select(name, "kelompok")
        clusters = cut(clusters.join(merged, "kelompok", "left").select("__core", F.coalesce("__into", "kelompok").alias("kelompok")))
