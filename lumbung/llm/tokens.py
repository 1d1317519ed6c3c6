"""Corpus encoding with a public byte-level BPE vocabulary as a bounded-lookahead streaming transducer.

Theory used: with a merge list ordered by rank, a token sequence is the encoding of its bytes exactly when every
neighbouring pair of tokens is stable, that is, when merging the bytes of the pair alone gives the pair back. So the last
token of every prefix is unique, and depends only on the last tokens of at most ``max_token`` earlier prefixes. The
transducer reads byte by byte and keeps for each of these prefixes its last token and a back link. Once the back links of
all prefixes that a future token can still reach meet in one prefix, the tokens before it are stable: no later byte can
change them, and they are emitted and forgotten. ``Vocabulary.lookahead`` is the bound of bytes that can be pending,
computed from the merge list; memory is constant in the length of the text.

Texts are cut into words by the vocabulary's public split pattern; texts longer than ``WINDOW`` are read in windows
which end before white space that follows other text, where the pattern always starts a new word.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 1 << 16
CACHED_WORDS = 200_000
CACHED_LENGTH = 64


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Ranks of a byte-level BPE vocabulary and what the transducer derives from its merge list."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern)
        self.max_token = max(map(len, ranks))
        self.depth = self._depth()
        self._stable: dict[tuple[bytes, bytes], bool] = {}

    @classmethod
    def load(cls, path: str | None = None) -> "Vocabulary":
        import public_tokenizers

        with open(path or vocabulary_path(), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return cls(ranks, public_tokenizers.PATTERN)

    def _depth(self) -> int:
        """Length of the longest chain of merges in which each needs the result of the one before."""
        depth: dict[bytes, int] = {}
        for token in sorted(self.ranks, key=lambda t: (len(t), self.ranks[t])):
            if len(token) == 1:
                depth[token] = 0
                continue
            left, right = self._parts(token)
            depth[token] = 1 + max(depth.get(left, 0), depth.get(right, 0))
        return max(depth.values())

    def _parts(self, token: bytes) -> tuple[bytes, bytes]:
        """The merge that makes the token: the two tokens left when every merge of a lower rank is done."""
        parts = self._merge(token, self.ranks[token])
        return (parts[0], parts[1]) if len(parts) == 2 else (token[:1], token[1:])

    def _merge(self, data: bytes, below: int) -> list[bytes]:
        """Merges of a rank under ``below``, lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    @property
    def lookahead(self) -> int:
        """Bytes after a token's end that suffice to know it is stable: each merge of the longest chain can reach back by
        one token at most."""
        return self.max_token * self.depth

    def stable(self, left: bytes, right: bytes) -> bool:
        found = self._stable.get((left, right))
        if found is None:
            found = self._merge(left + right, len(self.ranks)) == [left, right]
            if len(self._stable) > CACHED_WORDS:
                self._stable.clear()
            self._stable[left, right] = found
        return found


class Transducer:
    """Encodes one word that arrives in pieces; ``push`` and ``end`` give the ids that have become stable."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tail = b""  # the last max_token bytes
        self.at = 0
        self.last: dict[int, tuple[bytes, int]] = {0: (b"", -1)}  # prefix length: its last token and the prefix before
        self.done = 0  # the prefix whose tokens are emitted
        self.pending = 0  # most bytes ever pending, for tests of the bound

    def push(self, data: bytes) -> list[int]:
        out: list[int] = []
        v = self.v
        for i in range(len(data)):
            self.tail = (self.tail + data[i : i + 1])[-v.max_token :]
            self.at += 1
            at, tail = self.at, self.tail
            for size in range(min(len(tail), at - self.done), 0, -1):
                token = tail[-size:]
                if token in v.ranks and (before := self.last.get(at - size)) is not None:
                    if not before[0] or v.stable(before[0], token):
                        self.last[at] = (token, at - size)
                        break
            if at - self.done > 2 * v.max_token and at % v.max_token == 0:
                out += self._settle()
        self.pending = max(self.pending, self.at - self.done)
        return out

    def _settle(self) -> list[int]:
        """Emit up to the prefix where the back links of all reachable prefixes meet."""
        reach = {i for i in range(max(self.done, self.at - self.v.max_token + 1), self.at + 1) if i in self.last}
        while len(reach) > 1:
            top = max(reach)
            reach.discard(top)
            reach.add(self.last[top][1])
        meet = reach.pop()
        if meet <= self.done:
            return []
        out = self._path(meet)
        token = self.last[meet][0]
        self.last = {i: x for i, x in self.last.items() if i > meet} | {meet: (token, -1)}
        self.done = meet
        return out

    def _path(self, end: int) -> list[int]:
        out = []
        while end > self.done:
            token, end = self.last[end]
            out.append(self.v.ranks[token])
        return out[::-1]

    def end(self) -> list[int]:
        return self._path(self.at)


class Encoder:
    """Encodes texts; ids of repeated short words come from a bounded cache of the transducer's own results."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.words: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        data = word.encode()
        if (whole := self.v.ranks.get(data)) is not None:
            ids = [whole]
        else:
            transducer = Transducer(self.v)
            ids = transducer.push(data) + transducer.end()
        if len(word) <= CACHED_LENGTH:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known = self.words
        for window in windows(text or ""):
            for word in self.v.split.findall(window):
                ids = known.get(word)
                out += self.word(word) if ids is None else ids
        return out

    def length(self, text: str | None) -> int:
        return len(self.encode(text))


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """Pieces of about ``size`` characters that end where the split pattern always starts a new word."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and not (text[cut].isspace() and not text[cut - 1].isspace()):
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


class Decoder:
    """Incremental byte-to-text state machine: holds back only the bytes of an unfinished UTF-8 character."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.held = b""

    def push(self, ids: Iterable[int]) -> str:
        data = self.held + b"".join(self.v.bytes[i] for i in ids)
        keep = 0
        for back in range(1, min(4, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                need = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
                keep = back if need > back else 0
                break
        self.held = data[len(data) - keep :] if keep else b""
        return data[: len(data) - keep].decode(errors="replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode(errors="replace")


@lru_cache(maxsize=4)
def encoder(path: str | None = None) -> Encoder:
    """One encoder a worker process and vocabulary; its cache lives as long as the worker."""
    return Encoder(Vocabulary.load(path))


def ids_of(path: str | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            offsets, flat = np.zeros(batch.num_rows + 1, np.int32), []
            for k, text in enumerate(batch.column("__text").to_pylist()):
                ids = encode(text)
                flat.append(np.array(ids, np.int32))
                offsets[k + 1] = offsets[k] + len(ids)
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            columns = [batch.column(n) for n in batch.schema.names if n != "__text"]
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=[*names, "__ids"])

    return run


def encode(documents: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Every row with its token ids in column ``out``; one map-only pass, no shuffle.

    Null and empty texts give an empty list. Repeated rows stay repeated, an empty table gives an empty one. Only the
    columns ``keep`` (default: all but the text) travel to the Python workers; a column named like ``out`` is replaced.
    The path of the vocabulary is a parameter and must be readable on every executor.
    """
    keep = [c for c in (keep if keep is not None else documents.columns) if c not in (text, out)]
    rows = documents.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "__text"], T.StructField("__ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(ids_of(path), schema).withColumnRenamed("__ids", out)


def lengths_of(path: str | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = encoder(path).length
        for batch in batches:
            names = [n for n in batch.schema.names if n != "__text"]
            sizes = pa.array([length(t) for t in batch.column("__text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], sizes], names=[*names, "__n"])

    return run


def measured(documents: DataFrame, text: str = "text", out: str = "n_token", path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Like ``encode``, but only the number of tokens of each text; 0 for null and empty ones."""
    keep = [c for c in (keep if keep is not None else documents.columns) if c not in (text, out)]
    rows = documents.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "__text"], T.StructField("__n", T.LongType())])
    return rows.mapInArrow(lengths_of(path), schema).withColumnRenamed("__n", out)
