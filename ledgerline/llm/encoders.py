"""Encoders that remember the ids of pieces of text.

A piece is a stretch of a text that a tokenizer provably encodes alone, so whole texts
are encoded by looking their pieces up and encoding only the unknown ones.  Pieces are
cut, hashed, looked up and put together with numpy, a part of the texts at once.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from .words import byte_class, span_hashes, text_buffer

#: Pieces remembered in each of the two generations.
REMEMBERED = 700_000
#: Pieces of text that go to the tokenizer at once; its result takes about 1 KB a piece.
PIECES = 1 << 13
#: Pieces that are handed over as one text where that cannot change their ids.
JOINED = 256

# Bytes that begin a character which is surely not white space (lead bytes of blocks that
# hold white space are left out), and printable ASCII.
_SOLID = byte_class([*range(0x21, 0x7F), 0xC3, *range(0xC4, 0xE1), *range(0xE4, 0xF5)])
_PRINT = byte_class(range(0x21, 0x7F))
_BLANK, _FEED = 0x20, 0x0A


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... of count[i] each."""
    total = np.cumsum(count)
    return np.repeat(begin - (total - count), count) + np.arange(total[-1] if len(total) else 0)


def _places(data: np.ndarray, token: bytes) -> list[int]:
    """Where ``token`` (which doesn't overlap itself) stands."""
    raw, out = data.tobytes(), []
    at = raw.find(token)
    while at >= 0:
        out.append(at)
        at = raw.find(token, at + 1)
    return out


class _Generation:
    """Ids by piece hash: sorted keys, and where each one's ids lie."""

    def __init__(self, kind):
        self.keys, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.count, self.sound = np.zeros(0, np.int32), np.zeros(0, bool)
        self.flat, self.used = np.zeros(1 << 16, kind), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, row) of each key."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        row = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[row] == keys, row

    def add(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray, sound: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        begin = self.used + np.cumsum(count) - count
        self.used += len(ids)
        merged = np.concatenate([self.keys, keys])
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        for name, more in (("begin", begin), ("count", count.astype(np.int32)), ("sound", sound)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])

    def ids(self, row: np.ndarray) -> np.ndarray:
        return self.flat[_spread(self.begin[row], self.count[row].astype(np.int64))]


class PieceEncoder:
    """Encodes texts piece by piece.  A full younger generation becomes the older one, whose
    pieces move on when they occur again; what does not occur is forgotten with it.

    Subclasses say where pieces begin (``cut``) and encode them (``learn``).  ``size[id]``
    is the number of bytes a token stands for.
    """

    size: np.ndarray
    kind = np.uint16

    def __init__(self, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.young, self.old = _Generation(self.kind), _Generation(self.kind)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, count, sound): all ids, how many each piece has, and whether the bytes
        of its tokens are the piece."""
        raise NotImplementedError

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets, sound): the ids of text d are ids[offsets[d]:offsets[d + 1]];
        sound[d]: the bytes of its tokens are its text."""
        data, offsets = text_buffer(column)
        starts = self.cut(data, offsets)
        ends = np.append(starts[1:], len(data))
        codes, keys = pd.factorize(span_hashes(data, starts, ends))
        if len(self.young.keys) and len(self.young.keys) + len(keys) > self.remembered:
            self.young, self.old = _Generation(self.kind), self.young
        known, _ = self.young.find(keys)
        before, row = self.old.find(keys)
        before &= ~known
        moved = row[before]
        self.young.add(keys[before], self.old.ids(moved), self.old.count[moved].astype(np.int64), self.old.sound[moved])
        new = np.flatnonzero(~known & ~before)
        first = np.empty(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        raw = data.tobytes()
        for at in range(0, len(new), PIECES):
            some = new[at:at + PIECES]
            pieces = [raw[a:b] for a, b in zip(starts[first[some]].tolist(), ends[first[some]].tolist())]
            self.young.add(keys[some], *self.learn(pieces))
        found, row = self.young.find(keys)
        assert found.all()
        row = row[codes]
        count = self.young.count[row].astype(np.int64)
        total = np.append(0, np.cumsum(count))
        at = np.searchsorted(starts, offsets)
        wrong = np.append(0, np.cumsum(~self.young.sound[row]))
        return self.young.ids(row), total[at], wrong[at[1:]] == wrong[at[:-1]]


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of pieces that a byte-level BPE encodes independently, text starts included.

    The pre-tokenizer never joins a character with the white space after it, and splits a
    run of white space before its last character if something follows; a blank there
    belongs to what follows, a line feed stands alone.  So a piece may begin at a blank
    before a solid character, at a line feed after or before one, and after that line feed."""
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    if len(data):
        same = ~cut[1:-1]  # byte i and the next one are of the same text
        solid = _SOLID[data[1:]] & same
        feed = (data[:-1] == _FEED) & solid
        cut[:-2] |= ((data[:-1] == _BLANK) & solid) | feed
        cut[1:-1] |= feed | ((data[1:] == _FEED) & _PRINT[data[:-1]] & same)
    return np.flatnonzero(cut[:len(data)])


def _byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable bytes stand for themselves,
    the others for the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevelEncoder(PieceEncoder):
    """A byte-level BPE of the tokenizers library, given by the text of its definition.

    ``plain``: strings of added tokens inside a text are ordinary text; else each one is its
    token, and what stands before and after it is encoded as texts of their own, as by the
    library's default."""

    def __init__(self, definition: str, plain: bool = False, **options):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = plain
        size = self.tokenizer.get_vocab_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        super().__init__(**options)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()) or not all(t.special or not plain for t in added.values()):
            raise ValueError("added tokens that depend on what stands around them are not supported")
        self.added = [] if plain else [t.content.encode() for t in added.values()]
        alphabet = _byte_alphabet()
        self.size = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            in_bytes = i not in added and all(c in alphabet for c in token)
            self.size[i] = len(token) if in_bytes else len(token.encode())

    def cut(self, data, offsets):
        marks = [x for token in self.added for at in _places(data, token) for x in (at, at + len(token))
                 if np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(token) - 1, "right")]
        return pieces(data, np.union1d(offsets, marks).astype(np.int64) if marks else offsets)

    def learn(self, pieces):
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # a blank ends every piece of the pre-tokenizer before it, if no white space stands there
        joinable = np.fromiter((p[0] == _BLANK and _PRINT[p[-1]] and len(p) > 1 for p in pieces), bool, len(pieces))
        count = np.zeros(len(pieces), np.int64)
        together, alone = np.flatnonzero(joinable), np.flatnonzero(~joinable)
        groups = [together[i:i + JOINED] for i in range(0, len(together), JOINED)] + [alone[i:i + 1] for i in range(len(alone))]
        texts = [b"".join([pieces[i] for i in g.tolist()]).decode() for g in groups]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), self.kind, sum(map(len, found)))
        order = np.concatenate([together, alone])
        # where each piece's last token ends, in bytes
        upto, ends = np.cumsum(sizes[order]), np.cumsum(self.size[ids])
        last = np.searchsorted(ends, upto)
        assert len(ids) == 0 or np.array_equal(ends[last], upto), "a token crosses the end of its piece"
        count[order] = np.diff(last, prepend=-1)
        begin = np.empty(len(pieces), np.int64)
        begin[order] = np.append(0, last[:-1] + 1)
        return ids[_spread(begin, count)], count, np.ones(len(pieces), bool)


class SentencePieceEncoder(PieceEncoder):
    """A sentencepiece model, given as bytes.  A token stands for its piece with U+2581 as a
    blank, a byte token for its byte.

    Every text must begin with the blank that the model puts before a text.  No token of the
    vocabulary holds a blank after another character, so no merge crosses a single blank
    and the words between are pieces; a model with such tokens gets whole texts."""

    def __init__(self, model: bytes, **options):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.model.get_piece_size()
        self.kind = np.uint16 if n <= 1 << 16 else np.uint32
        super().__init__(**options)
        names = self.model.id_to_piece(list(range(n)))
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        self.size = np.fromiter(map(len, self.bytes), np.int64, n)
        self.apart = all(" " not in t.decode(errors="ignore").lstrip(" ") for t in self.bytes)

    def cut(self, data, offsets):
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        if len(data) > 2 and self.apart:
            blank = data == _BLANK
            space = blank.copy()
            for at in _places(data, "▁".encode()):
                space[at:at + 3] = True
            same = ~cut[1:-1]
            cut[1:-2] |= blank[1:-1] & ~space[:-2] & ~space[2:] & same[1:] & same[:-1]
        return np.flatnonzero(cut[:len(data)])

    def learn(self, pieces):
        found = self.model.encode([p[1:].decode() for p in pieces], num_threads=1)
        count = np.fromiter(map(len, found), np.int64, len(found))
        sound = np.fromiter((p[:1] == b" " and b"".join([self.bytes[i] for i in ids]) == p for p, ids in zip(pieces, found)), bool, len(found))
        return np.fromiter(chain.from_iterable(found), self.kind, int(count.sum())), count, sound
