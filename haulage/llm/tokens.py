"""Token ids of whole texts by the tokenizers library, each different piece of text encoded once per worker.

Both public tokenizers part texts at white space before they merge anything, so a text's ids are those
of its pieces, one after the other. Pieces are cut only where that is certain: before one of ``,.;:!?`` that
follows an ASCII letter (no part of either pattern goes on there), and before a run of spaces and line feeds
that follows another character:

- byte level: no part of the tokenizer's pattern has white space after something else. A text with any other
  white space is one piece, since its runs may go on to either side.
- word level: this tokenizer drops white space, and normalisation does not reach across it.

A special token's string in a text gives that token, as in the plain call; such strings hold none of the characters
at which texts are cut, so each lies in one piece.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa

from .workers import kept

# Pieces remembered: those met again, and those met once. A full memory starts anew. Byte level has half as many,
# for the memory of the pipeline's last stage, and takes longer for it.
AGAIN, ONCE = {True: 350_000, False: 700_000}, {True: 250_000, False: 500_000}
AT_ONCE = 20_000

_OTHER_SPACE = re.compile("[" + "".join(
    f"\\u{c:04x}" for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"
) + "]")


class Encoder:
    def __init__(self, file: str, spaces_kept: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.spaces_kept = spaces_kept
        self.known: dict[bytes, bytes] = {}
        self.once: dict[bytes, bytes] = {}

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (one more for the end). A missing text has none."""
        texts = texts.fill_null("")
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        ends -= ends[0]
        cut = _cuts(data)
        if self.spaces_kept:
            for i in np.flatnonzero(_odd(data, ends)).tolist():
                if _OTHER_SPACE.search(texts[i].as_py()):
                    cut[ends[i]:ends[i + 1]] = False
        cut[ends[:-1][ends[1:] > ends[:-1]]] = True
        begin = np.append(np.flatnonzero(cut), len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(begin), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        ids = self._ids(_values(coded.dictionary))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        table, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        which = coded.indices.to_numpy()
        own = size[which]
        upto = np.cumsum(own)
        tokens = table[np.repeat(first[which] - upto + own, own) + np.arange(upto[-1] if len(upto) else 0)]
        return tokens, np.append(0, upto)[np.searchsorted(begin, ends)]

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        known, once, new = self.known, self.once, []
        out = list(map(known.get, pieces))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            ids = once.pop(pieces[i], None)
            if ids is None:
                new.append(i)
            else:
                out[i] = known[pieces[i]] = ids
        if len(known) > AGAIN[self.spaces_kept]:
            known.clear()
        if len(once) > ONCE[self.spaces_kept]:
            once.clear()
        for at in range(0, len(new), AT_ONCE):
            some = [pieces[i] for i in new[at:at + AT_ONCE]]
            coded = self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
            for i, piece, c in zip(new[at:at + AT_ONCE], some, coded):
                out[i] = once[piece] = array("I", c.ids).tobytes()
        return out


def _values(array: pa.BinaryArray) -> list[bytes]:
    """Its values, of which none is missing."""
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset:array.offset + len(array) + 1].tolist()
    data = (array.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


_LETTER, _POINT = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_POINT[list(b",.;:!?")] = True


def _cuts(data: np.ndarray) -> np.ndarray:
    """Marks the first of every run of spaces and line feeds, and points after a letter."""
    space = (data == 32) | (data == 10)
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[1:] |= _POINT[data[1:]] & _LETTER[data[:-1]]
    return cut


def encoder(file: str, spaces_kept: bool) -> Encoder:
    """One for each Python worker, so that tasks find the pieces of those before them."""
    return kept(Encoder, file, spaces_kept)


def _odd(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Texts with a byte of white space other than spaces and line feeds, or that may begin such a character."""
    # 9, 11-13 and 28-31 are ASCII white space; the others begin with C2, E1, E2 or E3 in UTF-8.
    odd = np.zeros(256, dtype=bool)
    odd[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True
    upto = np.append(0, np.cumsum(odd[data]))
    return upto[ends[1:]] > upto[ends[:-1]]


def documents(encoder: Encoder, texts: pa.Array, end: int) -> Iterator[np.ndarray]:
    """Ids of every text with the end id."""
    tokens, at = encoder.encode(texts)
    closed = np.insert(tokens, at[1:], end).astype("<u4")
    at = at + np.arange(len(at))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield closed[a:b]


def tokenizer_file(name: str) -> str:
    return public_tokenizers.path(name)
