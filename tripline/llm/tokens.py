"""Token ids of whole texts, with public vocabularies. Files are parameters.

Both encoders give the ids of the ``tokenizers`` library and only reach them
faster; texts outside the case they are exact for go to the library itself.
"""

from __future__ import annotations

import base64
import os
import re
from array import array

import numpy as np

_encoders: dict[tuple, object] = {}


def _library(path: str):
    """The tokenizer, loaded once a worker. Its own threads stay off: Spark has the cores."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ByteEncoder:
    """Byte-level BPE by its rank file, the same vocabulary.

    Both libraries split by the same pattern, but each has its own Unicode
    tables, so texts beyond Latin letters and texts that may hold a special
    token take the slow way.
    """

    _other = re.compile(r"[^\x00-ɏ]|<\|")

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=table, special_tokens={})
        self.library = _library(path)

    def __call__(self, text: str) -> np.ndarray:
        if self._other.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.frombuffer(array("I", ids), dtype="<u4")


class WordEncoder:
    """Ids of a vocabulary that drops white space, with marks for the end of a word.

    Texts of Latin letters are cut into words here, each followed by a space,
    and merged by rank: in the rank table a space stands for the end of a word,
    since no token holds one. All other texts go to the library.
    """

    #: Of lower-case lines: all letters and single marks; then Latin at least.
    _marked = re.compile(r"[^a-zß-öø-ÿ .,]|[.,][.,]")
    _other = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]|<\|")
    #: What the library cuts out beside runs of letters, in its order.
    _cut = re.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-zß-öø-ÿ0-9]+)")

    def __init__(self, path: str):
        self.library = _library(path)
        self.merged = self._by_rank()

    def _by_rank(self):
        """The library's merges as ranks; None where ids don't follow the merges."""
        import tiktoken
        from tokenizers import pre_tokenizers

        letters = sorted(pre_tokenizers.ByteLevel.alphabet())
        plain = {c: ord(c) for c in letters if ord(c) < 256}
        spare = iter(b for b in range(256) if b not in plain.values())
        byte_of = plain | {c: next(spare) for c in letters if ord(c) >= 256}
        ranks = {}
        for token, number in self.library.get_vocab(with_added_tokens=False).items():
            body = token.removesuffix("</w>")
            if all(c in byte_of for c in body):
                raw = bytes(byte_of[c] for c in body)
                ranks[raw + b" " if body != token else raw] = number
        merges = min((n for raw, n in ranks.items() if len(raw.rstrip(b" ")) > 1), default=0)
        if any(ranks.get(bytes([b]) + end, merges) >= merges
               for b in range(256) for end in (b"", b" ")):
            return None
        return tiktoken.Encoding("merges", pat_str=r"\S++ ", mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> np.ndarray:
        spaced = self.merged and self._spaced(text)
        if spaced is None:
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.merged(spaced)  # its pattern passes over spaces that follow no word
        return np.frombuffer(array("I", ids), dtype="<u4")

    def _spaced(self, text: str) -> str | None:
        """Lower-case, a space after each word; None for a text that is not Latin."""
        lines = text.split("\n")
        for at, line in enumerate(lines):
            low = line.lower()
            if not self._marked.search(low):
                lines[at] = low.replace(".", " . ").replace(",", " , ")
                continue
            if self._other.search(line):
                return None
            for sign in "\t\v\f\r":
                low = low.replace(sign, " ")
            lines[at] = " ".join(self._cut.split(low))
        return " ".join(lines) + " "


def byte_encoder(path: str, ranks: str) -> ByteEncoder:
    key = (path, ranks)
    if key not in _encoders:
        _encoders[key] = ByteEncoder(path, ranks)
    return _encoders[key]


def word_encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
