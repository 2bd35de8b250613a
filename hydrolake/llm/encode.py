"""Token ids of whole texts with a public tokenizer, word by word from a cache.

The tokenizers library spends most of its time around the merges. Both vocabularies used
here split a text before they merge, so the ids of a text are the ids of its pieces one after
another; pieces repeat, and each is merged once per worker. Where a text could be split in
another way (white space beside a space), the library encodes the text as a whole.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from hydrolake.llm.common import CACHES

#: Letters, and the punctuation after them: all of ASCII but the apostrophe, which may start a piece.
_WORD = "([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)"
_CORE, _LINES = re.compile(_WORD), re.compile(f"{_WORD}\n{_WORD}")
#: Separators that Python takes for white space and the vocabularies do not.
_ODD = re.compile("[\x1c-\x1f]")
#: A space beside other white space: pieces there depend on both sides.
_RUN = re.compile(r" (?:(?=\s)|(?<=\s ))")
#: Entries kept per worker; later pieces are encoded each time they occur.
CHUNKS, CORES = 300_000, 300_000


def _byte_letters() -> list[str]:
    """The letter a byte-level vocabulary writes for each byte: printable bytes stand for
    themselves, all others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class _Chunks(dict):
    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encoder.chunk(chunk)
        if len(self) < CHUNKS:
            self[chunk] = ids
        return ids


class _Stops(dict):
    """Ids of punctuation on its own."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.whole(piece)
        if len(self) < 10_000:
            self[piece] = ids
        return ids


class Encoder:
    """``ids(text)``: little-endian unsigned 32-bit ids, equal to ``encode(text,
    add_special_tokens=False).ids`` of the library. ``plain``: the strings of special tokens are
    ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain
        self.vocab = self.tok.get_vocab_size()
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
        #: keeps: byte-level, the space before a word belongs to it. words: white space dropped.
        self.keeps = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre["add_prefix_space"] and not norm
        self.words = pre.get("type") == "Sequence" and bool(norm) and "</w>" == spec["model"]["end_of_word_suffix"]
        letters = _byte_letters()
        self.letters = dict(enumerate(letters))
        self.cores: dict[str, bytes] = {}
        self.stops = _Stops(self)
        self.chunks = _Chunks(self)

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def core(self, piece: str) -> bytes:
        """Ids of letters (with the space before them, if kept): one piece, merged by the model."""
        if (ids := self.cores.get(piece)) is None:
            shown = piece.encode().decode("latin-1").translate(self.letters)
            ids = np.array([t.id for t in self.tok.model.tokenize(shown)], "<u4").tobytes()
            if len(self.cores) < CORES:
                self.cores[piece] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        """Ids of what stands between two spaces (with the space before it, if kept)."""
        lead = " " if self.keeps else ""
        if m := _CORE.fullmatch(chunk):
            return self.core(lead + m[1] if self.keeps else m[1].lower()) + self.stops[m[2]]
        if self.keeps and (m := _LINES.fullmatch(chunk)):
            return self.core(lead + m[1]) + self.stops[m[2]] + self.stops["\n"] + self.core(m[3]) + self.stops[m[4]]
        return self.whole(lead + chunk)

    def ids(self, text: str) -> bytes:
        if not (self.keeps or self.words) or self.keeps and _RUN.search(text) or self.words and _ODD.search(text):
            return self.whole(text)
        if self.words:
            return b"".join(map(self.chunks.__getitem__, text.split()))
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.chunks.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(path, plain)


CACHES.append(encoder.cache_clear)
