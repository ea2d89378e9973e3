"""Token ids of whole texts by a public tokenizer file, with the ids of repeated words kept.

Both tokenizers cut a text before every single space or line feed between visible characters, whatever stands around, so
the ids of such a text are the ids of its units in turn. Units are found and hashed as byte spans of a whole batch; each
distinct one is encoded once by the tokenizers library as long as the table holds it. A text with other white space is
encoded whole. Units count as equal when their bytes are: the length, the first and the last eight bytes tell units of up
to 16 bytes apart, longer ones are looked up by all their bytes.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from .wordhash import mix, text_bytes

ENTRIES = 2_500_000
MARK = "|"
_HEAD = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
# every character but space and line feed that some library takes for white space or drops, and combining marks
_wide = re.compile("[\\x00-\\x09\\x0b-\\x1f\\x7f-\\xa0\\xad\\u0300-\\u036f\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u2064\\u3000\\ufeff]")
_encoders: dict[tuple[str, bool], UnitEncoder] = {}


class UnitEncoder:
    """Ids of texts as unsigned 16-bit arrays.

    drop_space: the tokenizer drops white space, and units go without. Else every unit but a text's first begins with its
    space or line feed, and so does its first token.
    """

    def __init__(self, path: str, drop_space: bool):
        os.environ |= {"TOKENIZERS_PARALLELISM": "false", "RAYON_NUM_THREADS": "1"}  # a task has one core
        from tokenizers import Tokenizer

        t = self.tokenizer = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        if t.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits; this vocabulary has more")
        self.drop_space = drop_space
        self.starts = np.zeros(1 << 16, dtype=bool)
        if drop_space:
            (mark,) = t.encode(MARK, add_special_tokens=False).ids
            self.starts[mark] = True
        else:
            self.starts[[i for token, i in t.get_vocab().items() if token[0] == "Ġ"]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.head, self.tail, self.bytes = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        self.long: dict[bytes, tuple[int, int]] = {}
        self.ids = np.zeros(0, dtype="<u2")

    def _plain(self, text: str) -> bool:
        if _wide.search(text):
            return False
        return self.drop_space or not (text[:1] in " \n" or text[-1:] in " \n" or "  " in text or " \n" in text or "\n\n" in text or "\n " in text)

    def _many(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u2") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        """The ids of each unit; those that begin like most are encoded 250 at a time and cut apart."""
        out: list = [None] * len(units)
        odd = [i for i, u in enumerate(units) if (MARK in u if self.drop_space else u[:1] != " ")]
        for i, ids in zip(odd, self._many([units[i] for i in odd]), strict=True):
            out[i] = ids
        rest = [i for i, x in enumerate(out) if x is None]
        parts = [rest[a : a + 250] for a in range(0, len(rest), 250)]
        between = f" {MARK} " if self.drop_space else ""
        for part, ids in zip(parts, self._many([between.join([units[i] for i in p]) for p in parts]), strict=True):
            cuts, skip = np.flatnonzero(self.starts[ids]), 0
            if self.drop_space:
                cuts, skip = np.r_[-1, cuts], 1
            assert len(cuts) == len(part)
            for i, a, b in zip(part, cuts.tolist(), [*cuts[1:].tolist(), len(ids)], strict=True):
                out[i] = ids[a + skip : b]
        return out

    def _add(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode new units; where their ids are in self.ids, and how many."""
        found = self._encode_units([u.decode() for u in units])
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        at = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, *found])
        return at, sizes

    def _look_up_long(self, units: list[bytes]) -> tuple[list[int], list[int]]:
        new = list(dict.fromkeys(u for u in units if u not in self.long))
        if new:
            at, size = self._add(new)
            self.long |= dict(zip(new, zip(at.tolist(), size.tolist(), strict=True), strict=True))
        return tuple(map(list, zip(*(self.long[u] for u in units), strict=True))) if units else ([], [])

    def _look_up(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each span are in self.ids, and how many."""
        if len(self.keys) + len(self.long) > ENTRIES:
            self._clear()
        n = end - start
        data = np.concatenate([raw, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(raw) + 1, dtype="<u8", buffer=data, strides=(1,))
        head = eight[start] & _HEAD[np.minimum(n, 8)]
        tail = np.where(n > 8, eight[np.maximum(end - 8, 0)], np.uint64(0))
        keys, first, back = np.unique(mix(head ^ mix(tail ^ (n.astype(np.uint64) << np.uint64(56)))), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known & (n[first] <= 16))
        at, size = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        if len(new):
            body = raw.tobytes()
            where, sizes = self._add([body[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            self.keys, self.at, self.size = (np.insert(x, place[new], y) for x, y in ((self.keys, keys[new]), (self.at, where), (self.size, sizes)))
            self.head, self.tail, self.bytes = (np.insert(x, place[new], y[first[new]]) for x, y in ((self.head, head), (self.tail, tail), (self.bytes, n)))
        odd = np.arange(len(n))
        if len(self.keys):
            mine = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)[back]
            at, size = self.at[mine].astype(np.int64), self.size[mine].astype(np.int64)
            # longer units, and any whose key another unit has
            odd = np.flatnonzero((n > 16) | (self.head[mine] != head) | (self.tail[mine] != tail) | (self.bytes[mine] != n))
        if len(odd):
            at[odd], size[odd] = self._look_up_long([raw[a:b].tobytes() for a, b in zip(start[odd].tolist(), end[odd].tolist(), strict=True)])
        return at, size

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of every text of a string column without nulls."""
        texts = column.to_pylist()
        plain = np.array([self._plain(t) for t in texts], dtype=bool)
        slow = np.flatnonzero(~plain)
        whole = dict(zip(slow.tolist(), self._many([texts[i] for i in slow]), strict=True))
        raw, offsets = text_bytes(column)
        space = (raw == 32) | (raw == 10)
        first = np.zeros(len(raw) + 1, dtype=bool)
        first[offsets[:-1]] = True
        first = first[:-1]
        if self.drop_space:
            start = np.flatnonzero(~space & (first | np.r_[True, space[:-1]])) if len(raw) else np.zeros(0, np.int64)
            stop = np.flatnonzero(space | first)
        else:
            start = stop = np.flatnonzero(space | first)
        end = np.r_[stop, len(raw)][np.searchsorted(stop, start, side="right")]
        row = np.searchsorted(offsets, start, side="right") - 1
        keep = plain[row]
        start, end, row = start[keep], end[keep], row[keep]
        at, size = self._look_up(raw, start, end)
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        cut = np.r_[0, ends][np.searchsorted(row, np.arange(len(texts) + 1))]
        return [whole[i] if i in whole else ids[cut[i] : cut[i + 1]] for i in range(len(texts))]


def encoder(path: str, drop_space: bool) -> UnitEncoder:
    """The encoder of this Python worker, loaded once."""
    key = (path, drop_space)
    if key not in _encoders:
        _encoders[key] = UnitEncoder(path, drop_space)
    return _encoders[key]
