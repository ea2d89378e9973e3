"""Byte-level BPE by a tree reduction.

A text is halved down to leaves; leaves are encoded, and neighbours joined: of the joint text only a window around the seam is
encoded again. The window grows on each side until it begins and ends at a place where every text is cut, whatever stands
around it: a white space after a character that is none. No match of the pattern spans such a place, and what
stands before it never changes the matches after it, so tokens outside the window are final. Joining is associative,
whatever the halving. Decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, with_text

SLICE = 1 << 20
LEAF = 2048
WINDOW = 64
# surely white space after what surely is none, in every version of Unicode
_seam = re.compile("[!-~À-ʯ](?=[ \n])")
_codecs: dict[tuple[str, str], Codec] = {}


class Node:
    """A stretch [start, end) of a text, its ids and the byte length of each."""

    __slots__ = ("end", "ids", "start")

    def __init__(self, start: int, end: int, ids: list[int]):
        self.start, self.end, self.ids = start, end, ids


class Codec:
    """Encoding and decoding by the ranks of one file and one pattern. Special tokens are ordinary text."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF, window: int = WINDOW):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.text = [str(i) for i in range(len(self.bytes))]
        self.leaf, self.window = leaf, window

    def _last_seam(self, text: str, low: int, high: int) -> int | None:
        """The last seam in (low, high), looked for in windows that double."""
        width = self.window
        while True:
            at = max(low, high - width)
            found = [m.end() for m in _seam.finditer(text, at, high)]
            found = [x for x in found if low < x < high]
            if found:
                return found[-1]
            if at == low:
                return None
            width *= 2

    def _first_seam(self, text: str, low: int, high: int) -> int | None:
        m = _seam.search(text, low, high)
        return m.end() if m and low < m.end() < high else None

    def _drop(self, ids: list[int], n: int, back: bool) -> list[int]:
        """Ids without the last (or first) ones that make up n bytes."""
        size, count = self.bytes, 0
        while n > 0:
            n -= len(size[ids[-1 - count if back else count]])
            count += 1
        if n:
            raise AssertionError("a seam is inside a token")
        return ids[: len(ids) - count] if back else ids[count:]

    def join(self, text: str, a: Node, b: Node) -> Node:
        if not a.ids or not b.ids:
            return Node(a.start, b.end, a.ids or b.ids)
        seam = a.end
        if text[seam] in " \n" and _seam.match(text, seam - 1, seam + 1):
            return Node(a.start, b.end, a.ids + b.ids)
        left, right = self._last_seam(text, a.start, seam), self._first_seam(text, seam, b.end)
        left, right = a.start if left is None else left, b.end if right is None else right
        kept = self._drop(a.ids, len(text[left:seam].encode()), True)
        rest = self._drop(b.ids, len(text[seam:right].encode()), False)
        return Node(a.start, b.end, kept + self.coder.encode_ordinary(text[left:right]) + rest)

    def tree(self, text: str, start: int, end: int) -> Node:
        if end - start <= self.leaf:
            return Node(start, end, self.coder.encode_ordinary(text[start:end]))
        middle = (start + end) // 2
        # a half begins at a seam if one is near, which leaves nothing to encode again
        near = _seam.search(text, middle, min(end, middle + self.window))
        middle = near.end() if near and near.end() < end else middle
        return self.join(text, self.tree(text, start, middle), self.tree(text, middle, end))

    def encode(self, text: str) -> list[int]:
        return self.tree(text, 0, len(text)).ids

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join([self.bytes[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def codec(path: str, pattern: str) -> Codec:
    """The codec of this Python worker, loaded once."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, ids. Null texts count as empty and have no ids. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in slices(batches, "text", SLICE):
            ids = [c.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return with_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of (doc_id, ids): doc_id and the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([c.decode(x or []) for x in batch.column("ids").to_pylist()], pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_tokens, ids_sha256 and decoded_sha256 of the ids and of the bytes they decode to.

    Null texts count as empty. Texts of any length are encoded whole; rows that repeat are encoded each. Texts that hold
    lone surrogates can't be in a table. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in slices(batches, "text", SLICE):
            n, a, b = [], [], []
            for text in batch.column("text").to_pylist():
                ids = c.encode(text)
                n.append(len(ids))
                a.append(hashlib.sha256(",".join([c.text[i] for i in ids]).encode()).hexdigest())
                b.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return with_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
