"""Public tokenizers inside tasks, with the work on repeated pieces done once.

A byte-level BPE splits a text before it merges, so a text may be cut wherever a split is certain, each
distinct piece encoded once by the library, and the ids strung together: they are the ids of the whole text.
The certain places used here: where a run of ASCII blanks begins, after a single blank other than a space, and
between a letter and a full stop, comma, colon, semicolon, exclamation or question mark. A text with other blanks or
with something like an added token is one piece.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterable

import numpy as np

from glyphatlas.llm.common import Words, span_hashes

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"

# Distinct pieces that a worker remembers; when full, it starts afresh, so memory is bounded.
MOST_PIECES = 3_000_000
# The same where a worker has two vocabularies at once.
SHARED_PIECES = 1_000_000
_TOGETHER = 1 << 19


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCache:
    """Ids of pieces by hash. `encode` turns a list of pieces into (ids of all, number of ids of each)."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = MOST_PIECES):
        self.encode, self.most = encode, most
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every piece where its ids begin in `self.ids`, and how many there are."""
        hashes = span_hashes(data, start, end)
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        distinct, first = ranked[new], order[new]
        at = np.searchsorted(self.keys, distinct)
        at[at == len(self.keys)] = 0
        missing = self.keys[at] != distinct if len(self.keys) else np.ones(len(distinct), bool)
        if missing.any():
            if len(self.keys) + int(missing.sum()) > self.most:
                self._reset()
                missing[:] = True
            self._learn(data, distinct[missing], start[first[missing]], end[first[missing]])
            at = np.searchsorted(self.keys, distinct)
        found = np.empty(len(hashes), np.int64)
        found[order] = at[np.cumsum(new) - 1]
        return self.start[found], self.size[found]

    def _learn(self, data: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        whole = data.tobytes()
        ids, sizes = self.encode([whole[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)])
        begin = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.start = np.concatenate([self.start, begin])[order]
        self.size = np.concatenate([self.size, sizes])[order]


def strung(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """ids[start:start+size] of all pieces, one after the other."""
    before = np.cumsum(size) - size
    return ids[np.repeat(start - before, size) + np.arange(int(size.sum()))]


# --- byte-level BPE -------------------------------------------------------------------------------------

_ASCII_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_STOP = np.isin(np.arange(256), [ord(c) for c in ".,:;!?"])


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of pieces that can be encoded on their own; they cover all rows and cross none."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate([[np.uint8(0)], data[:-1]])
    blank, blank_before = _ASCII_BLANK[data], _ASCII_BLANK[before]
    letter = _ASCII_LETTER[before]
    # U+00C0 to U+00FF are letters, but for the signs of multiplication and division
    letter[2:] |= (data[:-2] == 0xC3) & (before[2:] >= 0x80) & (before[2:] != 0x97) & (before[2:] != 0xB7)
    # of several blanks the last one is split off by what follows them
    single = blank_before.copy()
    single[2:] &= ~blank[:-2]
    cut = blank & ~blank_before | single & (before != 32) & ~blank | letter & _STOP[data]
    # other blanks of Unicode begin with these bytes, and added tokens look like <|...|>
    after = np.concatenate([data[1:], [np.uint8(0)]])
    odd = (data == 0xC2) & ((after == 0x85) | (after == 0xA0)) | (data == 0xE1) & (after == 0x9A)
    odd |= (data == 0xE2) & ((after == 0x80) | (after == 0x81)) | (data == 0xE3) & (after == 0x80)
    odd |= (data == ord("<")) & (after == ord("|"))
    for row in np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1):
        cut[offsets[row]:offsets[row + 1]] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], n)


def _byte_bpe(path: str, plain: bool = False):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = plain
    width = np.zeros(library.get_vocab_size(), np.int64)
    for token, i in library.get_vocab().items():
        width[i] = len(token)  # a byte-level token has one character for each byte

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # a piece that begins with a space and goes on with something else may stand behind another one
        joins = np.array([len(p) > 1 and p[0] == 32 and not _ASCII_BLANK[p[1]] for p in pieces])
        sizes = np.zeros(len(pieces), np.int64)
        found: list[np.ndarray] = []
        order: list[np.ndarray] = []

        def take(chosen: np.ndarray, texts: list[bytes]) -> None:
            ids = np.array(library.encode_batch_fast([b"".join(texts).decode()], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum([len(t) for t in texts])
            owner = np.searchsorted(ends, np.cumsum(width[ids]) - width[ids], "right")
            sizes[chosen] = np.bincount(owner, minlength=len(texts))
            found.append(ids)
            order.append(chosen)

        together = np.flatnonzero(joins)
        length = np.cumsum([len(pieces[i]) for i in together])
        for group in np.unique(length // _TOGETHER) if len(together) else ():
            chosen = together[length // _TOGETHER == group]
            take(chosen, [pieces[i] for i in chosen])
        alone = np.flatnonzero(~joins)
        encoded = library.encode_batch_fast([pieces[i].decode() for i in alone], add_special_tokens=False)
        for i, e in zip(alone, encoded, strict=True):
            sizes[i] = len(e.ids)
        if len(alone):
            order.append(alone)
            found.append(np.array([x for e in encoded for x in e.ids], np.int64))
        # back into the order of the pieces
        turn = np.concatenate(order)
        flat = np.concatenate(found)
        began = np.empty(len(pieces), np.int64)
        began[turn] = np.cumsum(sizes[turn]) - sizes[turn]
        return strung(flat, began, sizes), sizes

    return encode


@functools.lru_cache(maxsize=4)
def _byte_cache(path: str, plain: bool = False) -> PieceCache:
    return PieceCache(_byte_bpe(path, plain), SHARED_PIECES if plain else MOST_PIECES)


def byte_bpe_ids(path: str, data: np.ndarray, offsets: np.ndarray, plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The ids of every row's whole text, strung together, and the number of ids of each row; if `plain`, the strings of special
    tokens are ordinary text."""
    cache = _byte_cache(path, plain)
    start, end = _pieces(data, offsets)
    at, size = cache.places(data, start, end)
    return strung(cache.ids, at, size), _per_row(start, size, offsets)


def byte_bpe_lengths(path: str, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of ids of every row's whole text."""
    start, end = _pieces(data, offsets)
    return _per_row(start, _byte_cache(path).places(data, start, end)[1], offsets)


def _per_row(start: np.ndarray, size: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(size)])
    return np.diff(total[np.searchsorted(start, offsets)])


# --- pieces with byte fallback, word by word ---------------------------------------------------------------


def _piece_bpe(path: str):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    begins = np.array([library.id_to_piece(i).startswith("▁") for i in range(library.get_piece_size())])

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes: list[np.ndarray] = []
        found: list[np.ndarray] = []
        for group in _groups(words):
            ids = np.array(library.encode(b" ".join(group).decode(), num_threads=1), np.int64)
            starts = np.flatnonzero(begins[ids])
            if len(starts) == len(group):
                found.append(ids)
                sizes.append(np.diff(np.append(starts, len(ids))))
            else:  # a word holds the mark of a blank itself
                each = library.encode([w.decode() for w in group], num_threads=1)
                found.append(np.array([i for e in each for i in e], np.int64))
                sizes.append(np.array([len(e) for e in each], np.int64))
        return np.concatenate(found), np.concatenate(sizes)

    return encode


def _groups(words: list[bytes]) -> Iterable[list[bytes]]:
    group, size = [], 0
    for w in words:
        group.append(w)
        size += len(w) + 1
        if size > 1 << 16:
            yield group
            group, size = [], 0
    if group:
        yield group


@functools.lru_cache(maxsize=4)
def _piece_cache(path: str) -> PieceCache:
    return PieceCache(_piece_bpe(path))


def word_pieces(path: str, data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The piece ids of all words, strung together, and the number of pieces of each word."""
    cache = _piece_cache(path)
    at, size = cache.places(data, words.start, words.end)
    return strung(cache.ids, at, size), size


# --- pieces with byte fallback, whole texts ------------------------------------------------------------------

MARK = "\u2581"


@functools.lru_cache(maxsize=4)
def byte_bpe_bytes(path: str) -> tuple[bytes, ...]:
    """The bytes of every id of a byte-level vocabulary, in which a printable character stands for each byte."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    out = [b""] * library.get_vocab_size()
    for token, i in library.get_vocab().items():
        out[i] = bytes(byte_of[c] for c in token)
    return tuple(out)


@functools.lru_cache(maxsize=4)
def piece_bytes(path: str) -> tuple[bytes, ...]:
    """The bytes that every piece of a vocabulary with byte fallback stands for; control pieces stand for none."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        if library.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if library.is_control(i) or library.is_unknown(i) else piece.replace(MARK, " ").encode())
    return tuple(out)


def _spaced_bpe(path: str):
    """Ids of chunks of text that begin with spaces. No piece holds a blank after another character, so no merge crosses the
    place where a run of spaces begins. A chunk whose pieces do not give back its bytes has no ids."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    held = piece_bytes(path)
    width = np.array([len(b) for b in held])

    def alone(chunk: bytes) -> list[int]:
        # the library puts a space before a text; a chunk of spaces only is read behind a letter
        if chunk.strip(b" "):
            ids = library.encode(chunk[1:].decode(), num_threads=1)
        else:
            ids = library.encode("a" + chunk.decode(), num_threads=1)[1:]
        return ids if b"".join(held[i] for i in ids) == chunk else []

    def encode(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.zeros(len(chunks), np.int64)
        found: list[np.ndarray] = []
        at = 0
        for group in _groups(chunks):
            whole = b"".join(group)
            ids = np.zeros(0, np.int64)
            if all(c.strip(b" ") for c in group):
                ids = np.array(library.encode(whole[1:].decode(), num_threads=1), np.int64)
            if b"".join(held[i] for i in ids) == whole:
                owner = np.searchsorted(np.cumsum([len(c) for c in group]), np.cumsum(width[ids]) - width[ids], "right")
                sizes[at:at + len(group)] = np.bincount(owner, minlength=len(group))
                found.append(ids)
            else:
                each = [alone(c) for c in group]
                sizes[at:at + len(group)] = [len(e) for e in each]
                found.append(np.array([i for e in each for i in e], np.int64))
            at += len(group)
        return np.concatenate(found), sizes

    return encode


@functools.lru_cache(maxsize=4)
def _spaced_cache(path: str) -> PieceCache:
    return PieceCache(_spaced_bpe(path), SHARED_PIECES)


def spaced_piece_ids(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The piece ids of every row's whole text, strung together, and the number of ids of each row. Every row must begin with
    the space that the library adds."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    space = data == 32
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut)
    cache = _spaced_cache(path)
    at, size = cache.places(data, start, np.append(start[1:], len(data)))
    return strung(cache.ids, at, size), _per_row(start, size, offsets)
