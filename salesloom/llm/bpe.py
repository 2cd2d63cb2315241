"""Byte-level BPE encoding and decoding over a tree of text halves.

Method: monoid tree reduction. A text is halved until a piece is short, the pieces are encoded, and
neighbours are joined: only a window around the seam is encoded anew, and it grows until the tokens
outside it provably stay as they are. Two proofs are used:

- The split pattern never matches across a change from a non-blank to a blank character (or between an
  ASCII letter and an ASCII digit), so tokens on either side of such a place don't depend on the other.
- Inside one run of letters a token sequence is the encoding of its bytes if each pair of neighbours
  encodes to itself; so a window ends where the pair across its edge does.

Joining is associative, so the result is the encoding of the whole text, whatever the halves are.
Decoding concatenates bytes up the same tree. Memory per row is a few times its text; one row never
leaves its task, rows are independent, there is no shuffle.

Defined cases: null and empty texts have no tokens and decode to no bytes; extra columns pass
through, except those named like the result's own, which are replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salesloom.llm.frames import without


class Codec:
    """Encodes and decodes with a file of byte ranks; ``leaf`` is the longest piece in characters
    that is encoded at once."""

    def __init__(self, path: str, pattern: str, leaf: int = 8192):
        self.path, self.pattern, self.leaf = path, pattern, leaf

    def __getstate__(self):
        return {"path": self.path, "pattern": self.pattern, "leaf": self.leaf}

    @cached_property
    def table(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.coder._mergeable_ranks.items()}

    @cached_property
    def numbers(self) -> list[str]:
        return [str(i) for i in range(max(self.table) + 1)]

    @cached_property
    def coder(self) -> tiktoken.Encoding:
        with open(self.path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, low: int = 0, high: int | None = None) -> list[int]:
        high = len(text) if high is None else high
        if high - low <= self.leaf:
            return self.coder.encode_ordinary(text[low:high])
        middle = (low + high) // 2
        return self.join(text, low, middle, high, self.encode(text, low, middle), self.encode(text, middle, high))

    def join(self, text: str, low: int, seam: int, high: int, left: list[int], right: list[int]) -> list[int]:
        """Tokens of ``text[low:high]`` from those of its parts on either side of ``seam``."""
        size = 32
        while True:
            begin = self._cut_before(text, max(seam - size, low), seam)
            end = self._cut_after(text, seam, min(seam + size, high))
            if begin is None and seam - size <= low:
                begin = low
            if end is None and seam + size >= high:
                end = high
            if begin is not None and end is not None:
                encode = self.coder.encode_ordinary
                stable = len(left) - len(encode(text[begin:seam]))
                gone = len(encode(text[seam:end]))
                return left[:stable] + encode(text[begin:end]) + right[gone:]
            if text[max(seam - size, low) : min(seam + size, high)].isalpha():
                joined = self._join_inside(left, right, size // 8)
                if joined is not None:
                    return joined
            size *= 2

    def _join_inside(self, left: list[int], right: list[int], count: int) -> list[int] | None:
        """Join within a run of letters, encoding ``count`` tokens on each side; None if that is too few."""
        piece, token = self.coder._encode_single_piece, self.table
        if len(left) <= count or len(right) <= count:
            return None
        window = piece(b"".join(token[i] for i in left[-count:] + right[:count]))
        for a, b in ((left[-count - 1], window[0]), (window[-1], right[count])):
            if piece(token[a] + token[b]) != [a, b]:
                return None
        return left[:-count] + window + right[count:]

    @staticmethod
    def _cuts(a: str, b: str) -> bool:
        if b in " \n":
            return not a.isspace()
        return a.isascii() and b.isascii() and (a.isalpha() and b.isdigit() or a.isdigit() and b.isalpha())

    def _cut_before(self, text: str, low: int, seam: int) -> int | None:
        """The earliest place from ``low`` on, before ``seam``, at which the pattern always splits."""
        return next((i for i in range(low + 1, seam) if self._cuts(text[i - 1], text[i])), None)

    def _cut_after(self, text: str, seam: int, high: int) -> int | None:
        return next((i for i in range(high - 1, seam, -1) if self._cuts(text[i - 1], text[i])), None)

    def decode(self, tokens: list[int]) -> bytes:
        if len(tokens) <= self.leaf:
            table = self.table
            return b"".join([table[i] for i in tokens])
        middle = len(tokens) // 2
        return self.decode(tokens[:middle]) + self.decode(tokens[middle:])


def encode_texts(docs: DataFrame, codec: Codec) -> DataFrame:
    """``docs`` with ``tokens``, the ids of ``text``."""
    docs = without(docs, "tokens")
    names = [*docs.columns, "tokens"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array([codec.encode(x or "") for x in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("tokens", T.ArrayType(T.IntegerType()))]))


def decode_tokens(docs: DataFrame, codec: Codec) -> DataFrame:
    """``docs`` with ``decoded``, the bytes of ``tokens``."""
    docs = without(docs, "decoded")
    names = [*docs.columns, "decoded"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = pa.array([codec.decode(x or []) for x in batch.column("tokens").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, content], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("decoded", T.BinaryType())]))


def round_trip(docs: DataFrame, codec: Codec) -> DataFrame:
    """``docs`` without ``text`` but with ``n_tokens`` and the digests ``ids_sha256`` (decimal ids joined by
    commas) and ``decoded_sha256``: the tokens themselves stay in the task."""
    added = ("n_tokens", "ids_sha256", "decoded_sha256")
    docs = without(docs, *added)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids, contents = [], [], []
            for text in batch.column("text"):
                tokens = codec.encode(text.as_py() or "")
                numbers = codec.numbers
                counts.append(len(tokens))
                ids.append(hashlib.sha256(",".join([numbers[i] for i in tokens]).encode()).hexdigest())
                contents.append(hashlib.sha256(codec.decode(tokens)).hexdigest())
            made = [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(contents, pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], names=[*kept, *added])

    fields = [f for f in docs.schema.fields if f.name != "text"]
    kinds = (T.LongType(), T.StringType(), T.StringType())
    return docs.mapInArrow(run, T.StructType([*fields, *[T.StructField(n, k) for n, k in zip(added, kinds, strict=True)]]))
