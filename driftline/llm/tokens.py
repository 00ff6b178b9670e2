"""Token ids of whole texts by a public tokenizer, with a bounded cache of words."""

from __future__ import annotations

import os
import re

import numpy as np

#: Bytes, roughly, that the pieces of one generation may take; a worker holds two generations.
CACHE_BYTES = 96 << 20
#: What a remembered piece costs besides its characters and ids.
_ENTRY_BYTES = 200
#: Pieces that one call of the library gets at most.
_CALL = 4096

#: A piece of letters and ASCII marks after them; apostrophes may open a contraction and stay out,
#: other marks may be accents that the normalizer joins with the letter before them. A dotted
#: capital I stays out too: in lower case it ends in an accent.
_PLAIN = re.compile(r"([^\W\d_\u0130]+)([!-&(-/:-@\[-^`{-~]*)")
_loaded: dict[tuple[str, bool], WordTokenizer] = {}


def default_tokenizer() -> str:
    """Where the word-level vocabulary lies; every function takes another path too."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of texts for a vocabulary that drops white space and never merges across it.

    A text is cut at spaces and line feeds, and the ids of each different piece are
    remembered as bytes; a text's ids are the joined bytes. A piece of letters with
    ASCII marks after them is the ids of both, so only different words reach the
    ``tokenizers`` library, many in one call, where ids that end a word part them.
    The result equals ``encode(text, add_special_tokens=False)`` because the
    vocabulary's pre-tokenizer removes white space and parts letters from marks, and
    its normalizer works inside pieces and never joins an ASCII mark with a letter.
    Any other piece, so every one with a combining accent, is left to the library whole.

    Pieces are kept in two generations, each bounded in bytes: a full one becomes the
    older, and what is met again moves to the younger, so frequent words stay.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if plain:
            self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def _whole(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for a in range(0, len(pieces), _CALL):
            encoded = self.tokenizer.encode_batch_fast(pieces[a : a + _CALL], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, each of which is one run for the merges."""
        out: list[bytes] = []
        for a in range(0, len(words), _CALL):
            part = words[a : a + _CALL]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                out += self._whole(part)
                continue
            raw, begin = ids.tobytes(), 0
            for end in (4 * cuts).tolist():
                out.append(raw[begin:end])
                begin = end
        return out

    def _learned(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pieces that neither generation holds."""
        words, split, other = set(), [], set()
        for p in pieces:
            core, marks = p, ""
            if p[-1] in ".,":
                core, marks = p[:-1], p[-1]
            if not core.isalpha() or "\u0130" in core:
                m = _PLAIN.fullmatch(p)
                if not m:
                    other.add(p)
                    continue
                core, marks = m.groups()
            core = core.lower() if core.isascii() else core
            split.append((p, core, marks))
            words.add(core)
            if marks:
                other.add(marks)
        held = words.union(other)
        found = {p: self.known.get(p) or self.older[p] for p in held if p in self.known or p in self.older}
        words.difference_update(found)
        other.difference_update(found)
        found.update(zip(words, self._words(list(words)), strict=True))
        found.update(zip(other, self._whole(list(other)), strict=True))
        found[""] = b""
        found.update([(p, found[core] + found[marks]) for p, core, marks in split])
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        pieces = [t.replace("\n", " ").split(" ") for t in texts]
        wanted: set[str] = set()
        wanted.update(*pieces)
        wanted.discard("")
        if self.held > CACHE_BYTES:
            self.known, self.older, self.held = {}, self.known, 0
        missing = wanted.difference(self.known)
        fresh = {p: self.older[p] for p in missing if p in self.older}
        fresh.update(self._learned(missing.difference(fresh)))
        self.held += sum(map(len, fresh)) + sum(map(len, fresh.values())) + _ENTRY_BYTES * len(fresh)
        self.known.update(fresh)
        self.known[""] = b""
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


def tokenizer(path: str, plain: bool = False) -> WordTokenizer:
    """The worker's own tokenizer for ``path``, loaded once in a process."""
    if (path, plain) not in _loaded:
        _loaded[path, plain] = WordTokenizer(path, plain)
    return _loaded[path, plain]
