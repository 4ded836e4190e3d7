"""Tokenizing whole texts with the tokenizers library, once for each distinct piece.

A blank that some other character follows always begins a new pre-token of a byte-level BPE, so a text can
be cut there, and the ids of a piece do not depend on its neighbours. Pieces repeat, so their ids are kept,
found again by a 64-bit hash and the length of the piece, for many texts at once. Texts where the cut is not
sure (two blanks in a row, a blank at an end, a special token's string) are encoded whole.
"""

from __future__ import annotations

import gc
import os
from array import array
from codecs import charmap_decode

import numpy as np

from .util import _powers, mix

#: ASCII marks that a byte-level BPE never joins with letters before them.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_loaded: dict[str, Encoder] = {}


class Encoder:
    """encode(texts) gives one array of ids for each text. `most` bounds the pieces kept; beyond, all go."""

    def __init__(self, path: str, most: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.size = self.tok.get_vocab_size()
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.code = "H" if self.dtype == np.uint16 else "I"
        self.most = most
        # the usual one-character names of bytes: printable Latin-1 as it is, the rest from U+0100 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = iter(range(256, 512))
        self.letters = "".join(chr(b if b in plain else next(rest)) for b in range(256))
        self.special = [x.content for x in self.tok.get_added_tokens_decoder().values()]
        self.cut = type(self.tok.pre_tokenizer).__name__ == "ByteLevel" and self.tok.normalizer is None
        lengths = np.zeros(self.size, np.int64)
        for token, i in self.tok.get_vocab().items():
            lengths[i] = len(token)  # a byte-level token has one character for each byte
        self.lengths = lengths
        self.marks: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        """Pieces: two sorted tables (many, and those since) of hash, byte length, begin and number of ids; -1: not sure."""
        none = np.zeros(0, np.int32)  # ids kept are few enough
        self.tables = [(np.zeros(0, np.uint64), none, none, none)] * 2
        self.ids, self.used = np.zeros(1 << 20, self.dtype), 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> list[bytes | None]:
        """Ids of ' ' + piece for each distinct piece; None where the cut before it is not sure."""
        out: list[bytes | None] = [None] * len(new)
        stems: dict[str, bytes] = {}
        odd, tokenize, blank, marks = [], self.tok.model.tokenize, self.letters[32], self.marks
        for k, x in enumerate(new):
            stem = x.rstrip(_MARKS)
            if not stem.isalpha():
                if x and not x[0].isspace():
                    odd.append(k)
                continue
            ids = stems.get(stem)
            if ids is None:
                word = blank + (stem if stem.isascii() else charmap_decode(stem.encode(), "strict", self.letters)[0])
                ids = stems[stem] = array(self.code, [t.id for t in tokenize(word)]).tobytes()
            if len(stem) < len(x):
                mark = x[len(stem) :]
                end = marks.get(mark)
                if end is None:
                    end = marks[mark] = self._whole([mark])[0].tobytes()
                ids += end
            out[k] = ids
        if len(marks) > 100_000:
            marks.clear()
        for i in range(0, len(odd), 256):
            some = [new[k] for k in odd[i : i + 256]]
            ids = self._whole([" " + " ".join(some)])[0]
            ends = np.cumsum([1 + len(x.encode()) for x in some])
            at = (np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1) * ids.itemsize
            raw, a = ids.tobytes(), 0
            for k, z in zip(odd[i : i + 256], at.tolist()):
                out[k], a = raw[a:z], z
        return out

    def _keep(self, key: np.ndarray, size: np.ndarray, got: list[bytes | None]) -> None:
        """Adds pieces that no table has; key is sorted."""
        flat = np.frombuffer(b"".join(x or b"" for x in got), self.dtype)
        n = np.array([-1 if x is None else len(x) // flat.itemsize for x in got], np.int64)
        begin = self.used + np.cumsum(np.maximum(n, 0)) - np.maximum(n, 0)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.tables[1] = self._joined(self.tables[1], (key, size.astype(np.int32), begin.astype(np.int32), n.astype(np.int32)))
        if len(self.tables[1][0]) > 50_000 + len(self.tables[0][0]) // 8:
            self.tables = [self._joined(*self.tables), tuple(x[:0] for x in self.tables[1])]

    @staticmethod
    def _joined(a: tuple, b: tuple) -> tuple:
        both = [np.concatenate(x) for x in zip(a, b)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)

    def _find(self, key: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and number of ids of each piece; -2 where it is not known."""
        begin, n = np.zeros(len(key), np.int64), np.full(len(key), -2)
        for keys, sizes, begins, ns in self.tables:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = (keys[at] == key) & (sizes[at] == size)
                begin[hit], n[hit] = begins[at[hit]], ns[at[hit]]
        return begin, n

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.cut:
            return self._whole(texts)
        collects = gc.isenabled()
        gc.disable()  # many short lists, no cycles
        try:
            out: list = [None] * len(texts)
            rows, size = [], 0
            for k, s in enumerate(texts):
                if not s:
                    out[k] = np.zeros(0, self.dtype)
                elif any(x in s for x in self.special):
                    out[k] = self._whole([s])[0]
                else:
                    rows.append(k)
                    size += len(s)
                    if size >= 1 << 20:
                        self._some(texts, rows, out)
                        rows, size = [], 0
            if rows:
                self._some(texts, rows, out)
            return out
        finally:
            if collects:
                gc.enable()

    def _some(self, texts: list[str], rows: list[int], out: list) -> None:
        """Ids of the texts of `rows`, none of them empty."""
        raw = [texts[k].encode() for k in rows]
        data = np.frombuffer(b"".join(raw), np.uint8)
        bounds = np.cumsum([0, *map(len, raw)])
        blank = np.flatnonzero(data == 32)
        # a text's pieces begin with it and after its blanks; at equal places the earlier text's come first
        start = np.concatenate([blank + 1, bounds[:-1]])
        order = np.argsort(start, kind="stable")
        start, head = start[order], order >= len(blank)
        end = np.sort(np.concatenate([bounds[1:], blank]), kind="stable")
        p, q = _powers(len(data) + 1)
        c = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=c[1:])
        key = mix((c[end] - c[start]) * q[start]) ^ np.where(head, np.uint64(0x5851F42D4C957F2D), np.uint64(0))
        one, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        size = end[first] - start[first]
        begin, n = self._find(one, size)
        new = np.flatnonzero(n == -2)
        if len(new):
            if len(self.tables[0][0]) + len(self.tables[1][0]) + len(new) > self.most:
                self._forget()
                new = np.arange(len(one))
            whole = data.tobytes()
            a, z, lead = start[first[new]].tolist(), end[first[new]].tolist(), head[first[new]].tolist()
            pieces = [whole[x:y].decode() for x, y in zip(a, z)]
            learned = iter(self._learn([x for x, h in zip(pieces, lead) if not h]))
            leads = iter(self._whole([x for x, h in zip(pieces, lead) if h]))
            self._keep(one[new], size[new], [next(leads).tobytes() if h else next(learned) for h in lead])
            begin, n = self._find(one, size)
        many = n[inverse]
        text = np.cumsum(head) - 1
        unsure = np.unique(text[many < 0])
        many = np.maximum(many, 0)
        ends = np.cumsum(many)
        flat = self.ids[np.repeat(begin[inverse] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
        last = ends[np.append(np.flatnonzero(head)[1:], len(head)) - 1].tolist()
        a = 0
        for k, z in zip(rows, last):
            out[k], a = flat[a:z], z
        for t in unsure.tolist():
            out[rows[t]] = self._whole([texts[rows[t]]])[0]


def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
