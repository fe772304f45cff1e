"""Byte-level BPE as a monoid: encodings of halves are joined, texts are concatenated.

A sequence of tokens is the encoding of its bytes exactly when each pair of
neighbours is the encoding of its own bytes. So two encodings are joined by
re-encoding a window around the boundary and growing it, token by token, until
its outer tokens form such stable pairs with the tokens outside: then every
pair of the whole is stable and the whole is the encoding. Of a growing window
only the end that is not stable yet is encoded anew, so a run of one character,
through which a remainder moves to the far end, costs a step a token. Decoding
concatenates the tokens' bytes up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from riskfeat.llm.common import spare, whole_texts

VOCABULARY = "byte_bpe_50k.tiktoken"
NONE = 1 << 62  # rank of what is no token
LEAF = 4  # bytes that are merged directly
LEAF_IDS = 1024  # ids that are decoded directly
DIRECT = 256  # bytes up to which the least pair is looked for by scanning
STEPS = 64  # re-encoded pairs a token after which a join starts over from the bytes
_KEPT = 1 << 17  # entries of a memo before it starts anew


class Memo(dict):
    """A dict that computes missing values and never holds more than twice ``_KEPT`` of them.

    When it is full its entries become the old generation; what is asked for
    again comes back from there, the rest goes at the next turn.
    """

    def __init__(self, compute) -> None:
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key):
        if len(self) >= _KEPT:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}


class Codec:
    """Encoder and decoder over one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF) -> None:
        self.ranks, self.leaf = ranks, leaf
        self.bytes_of = {v: k for k, v in ranks.items()}
        self._window: Memo = Memo(lambda tokens: self.merge(self.decode(tokens)))
        self._tree: Memo = Memo(self._encode)

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Encoding by definition: merge the leftmost pair of least rank while there is one."""
        if len(data) > DIRECT:
            return self._merge_long(data)
        rank_of = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank_of(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            at = pairs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + parts[at], NONE)
            if at < len(pairs):
                pairs[at] = rank_of(parts[at] + parts[at + 1], NONE)
        return tuple([self.ranks[p] for p in parts])

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        """``merge`` with the pairs in a heap and the parts in a linked list."""
        rank_of, n = self.ranks.get, len(data)
        after, before, end = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(rank, i) for i in range(n - 1) if (rank := rank_of(data[i:i + 2])) is not None]
        heapify(heap)
        gone = bytearray(n)
        while heap:
            rank, i = heappop(heap)
            j = after[i] if not gone[i] else n
            if j >= n or rank_of(data[i:end[j]]) != rank:
                continue  # one of its parts has been merged since
            gone[j], end[i], after[i] = 1, end[j], after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (rank := rank_of(data[k:end[after[k]]])) is not None:
                    heappush(heap, (rank, k))
        return tuple([self.ranks[data[i:end[i]]] for i in range(n) if not gone[i]])

    def stable(self, left: int, right: int) -> bool:
        """Whether two neighbours are the encoding of their own bytes."""
        return self._window[left, right] == (left, right)

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of both halves together, from the encodings of each."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        done, rest = list(left), list(reversed(right))
        outside = len(rest)  # tokens of the right half that the window has not reached
        steps = STEPS * (len(left) + len(right))
        while rest:
            if not done:
                done.append(rest.pop())
                continue
            pair = done[-1], rest[-1]
            window = self._window[pair]
            if window == pair:
                if len(rest) == outside:
                    break
                done.append(rest.pop())
                continue
            steps -= 1
            if steps < 0:  # not seen to happen: nothing proves that the window settles
                return self.merge(self.decode(left) + self.decode(right))
            done.pop()
            rest.pop()
            outside = min(outside, len(rest))
            rest.extend(reversed(window))
            if done:
                rest.append(done.pop())
        done.extend(reversed(rest))
        return tuple(done)

    def _encode(self, data: bytes) -> tuple[int, ...]:
        n = len(data)
        if n <= self.leaf:
            return self.merge(data)
        middle = n // 2
        if n > 32:  # long halves rarely come again: only short ones are remembered
            return self.join(self._encode(data[:middle]), self._encode(data[middle:]))
        return self.join(self._tree[data[:middle]], self._tree[data[middle:]])

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Token ids of one match of the pattern."""
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else self._encode(data)

    def decode(self, ids) -> bytes:
        n = len(ids)
        if n > LEAF_IDS:
            return self.decode(ids[:n // 2]) + self.decode(ids[n // 2:])
        return b"".join([self.bytes_of[i] for i in ids])

    def forget(self) -> None:
        self._window.forget()
        self._tree.forget()


ASCII, BASIC = 0x7F, 0xFFFF


@cache
def letters(last: int) -> tuple[str, str]:
    """Bodies of character classes of all letters and of all numbers up to code point ``last``."""
    every = "".join(map(chr, range(last + 1)))

    def ranges(kind: str) -> str:
        return "".join(f"\\U{m.start():08x}-\\U{m.end() - 1:08x}" for m in regex.finditer(rf"\p{{{kind}}}+", every))

    return ranges("L"), ranges("N")


SPACE = r"\t-\r \x85\xa0  -     　"


@cache
def splitter(pattern: str, last: int = sys.maxunicode):
    """findall of ``pattern`` for texts of code points up to ``last``.

    Its classes are spelt out for ``re``, which is several times faster and
    fastest where they are small. Patterns that use more than \\p{L}, \\p{N},
    \\s and \\S keep the regex module.
    """
    plain = pattern.replace(r"\p{L}", "").replace(r"\p{N}", "")
    if r"\p" in plain or r"\w" in plain or r"\d" in plain or "(?i" in plain:
        return regex.compile(pattern).findall
    l, n = letters(last)
    out, inside, i = [], False, 0
    while i < len(pattern):
        two, one = pattern[i:i + 2], pattern[i]
        if pattern[i:i + 5] in (r"\p{L}", r"\p{N}"):
            body = l if pattern[i + 3] == "L" else n
            out.append(body if inside else f"[{body}]")
            i += 5
        elif two in (r"\s", r"\S"):
            if inside and two == r"\S":
                return regex.compile(pattern).findall
            out.append(SPACE if inside else f"[{'^' if two == chr(92) + 'S' else ''}{SPACE}]")
            i += 2
        else:
            inside = one == "[" or (inside and one != "]")
            out.append(two if one == "\\" else one)
            i += 2 if one == "\\" else 1
    return re.compile("".join(out)).findall


@cache
def codec(path: str) -> Codec:
    with open(path, "rb") as f:
        return Codec({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


def _pack(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class TextCoder:
    """Whole texts: the pieces of the pattern, each through the tree, side by side."""

    def __init__(self, path: str, pattern: str) -> None:
        self.codec = codec(path)
        self.ascii, self.basic, self.whole = (splitter(pattern, n) for n in (ASCII, BASIC, sys.maxunicode))
        self.packed = Memo(lambda piece: _pack(self.codec.encode(piece.encode())))
        self.spelt = Memo(lambda packed: self.codec.decode(memoryview(packed).cast("I")))

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern."""
        if text.isascii():
            return self.ascii(text)
        return (self.basic if len(text.encode("utf-16-le")) == 2 * len(text) else self.whole)(text)

    def encode(self, text: str) -> list[bytes]:
        """Little-endian unsigned 32-bit ids, piece by piece."""
        packed = self.packed
        return [packed[p] for p in self.pieces(text)]

    def decode(self, packed: list[bytes]) -> bytes:
        spelt = self.spelt
        return b"".join([spelt[p] for p in packed])

    def forget(self) -> None:
        """Drop what is remembered of pieces; the ranks stay."""
        self.packed.forget()
        self.spelt.forget()
        self.codec.forget()


def _default(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path(VOCABULARY)
        pattern = pattern or public_tokenizers.PATTERN
    return path, pattern


_coders: dict[tuple[str, str], TextCoder] = {}


def _coder(path: str, pattern: str) -> TextCoder:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = TextCoder(path, pattern)
    return _coders[path, pattern]


@contextmanager
def _coding(path: str, pattern: str) -> Iterator[TextCoder]:
    """The coder for one task, whose memos end with it.

    An executor keeps more Python workers than it runs tasks and takes them in
    turn: memos that outlive their task fill every one of them.
    """
    coder = _coder(path, pattern)
    try:
        yield coder
    finally:
        coder.forget()


_DIGESTS = StructType().add("n_tokens", LongType()).add("ids_sha256", StringType()).add(
    "decoded_sha256", StringType())


def digests(text: str = "text", path: str | None = None, pattern: str | None = None):
    """Column: struct of the number of tokens and the hashes of ids and of the decoded bytes.

    NULL text counts as empty. ``path`` names the rank file on every executor,
    ``pattern`` what splits texts before merging; both default to the public
    50k vocabulary.
    """
    where = _default(path, pattern)

    @F.arrow_udf(_DIGESTS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with _coding(*where) as coder:
            for texts in batches:
                rows = ([], [], [])
                for t in texts:
                    packed = coder.encode(t.as_py() or "")
                    ids = b"".join(packed)
                    rows[0].append(len(ids) // 4)
                    rows[1].append(hashlib.sha256(ids).hexdigest())
                    rows[2].append(hashlib.sha256(coder.decode(packed)).hexdigest())
                yield pa.StructArray.from_arrays(
                    [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                    ["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(F.col(text))


def token_ids(text: str = "text", path: str | None = None, pattern: str | None = None):
    """Column: the token ids of each text as little-endian unsigned 32-bit integers, in binary."""
    where = _default(path, pattern)

    @F.arrow_udf(BinaryType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with _coding(*where) as coder:
            for texts in batches:
                yield pa.array([b"".join(coder.encode(t.as_py() or "")) for t in texts], pa.binary())

    return run(F.col(text))


def decoded(ids: str = "ids", path: str | None = None, pattern: str | None = None):
    """Column: the bytes that binary ids of ``token_ids`` stand for; NULL stays NULL."""
    where = _default(path, pattern)

    @F.arrow_udf(BinaryType())
    def run(packed: pa.Array) -> pa.Array:
        decode = _coder(*where).codec.decode
        return pa.array([None if p is None else decode(memoryview(p).cast("I"))
                         for p in packed.to_pylist()], pa.binary())

    return run(F.col(ids))


def encoded(docs: DataFrame, **where: str) -> DataFrame:
    """``docs`` with ids and n_tokens in place of the text.

    Rows, NULL ids and other columns are kept; columns of ``docs`` named ids
    or n_tokens give way with underscores in front of the new names. NULL and
    empty texts have no ids. An empty table gives no rows.
    """
    ids = spare("ids", docs.columns)
    return whole_texts(docs).withColumn(ids, token_ids(**where)).withColumn(
        spare("n_tokens", docs.columns), (F.octet_length(ids) / 4).cast("bigint")).drop("text")
