"""Token ids of whole texts with a `tokenizers` file, remembered per word."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

#: The tokenizer's mark of a word's last token, signs that are pieces behind a word of plain letters, and how it splits
#: a word into pieces, written for words of `COMMON` alone.
WORD_END = "</w>"
SIGNS = frozenset((b".", b",", b";", b":", b"!", b"?"))
COMMON = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space and never merges across it.

    For such a tokenizer the ids of a text are those of its words one after another, so each distinct word, and each distinct
    piece of words of common letters, goes to the library once. Only ASCII white space splits here; any other character stays
    inside a word. Words with rarer letters or special tokens go through the whole tokenizer; for the rest its
    normalizer does no more than lower-case.

    Words and pieces are remembered in two generations of about `limit` each: once the younger is full it becomes the older one, and what is
    met again moves to the younger. So what is frequent stays and memory is bounded.
    """

    def __init__(self, path: str, limit: int = 600_000) -> None:
        self.full = Tokenizer.from_file(path)
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.zeros(self.full.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in self.full.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.limit = limit
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [(text.lower() if text.isascii() and b"<|" not in text else text).split() for text in texts]
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        self._learn(self._unknown(set().union(*split)))
        found = self.known.__getitem__
        return [b"".join(map(found, words)) for words in split]

    def _unknown(self, words: set[bytes]) -> set[bytes]:
        """Those in neither generation; those of the older one move to the younger."""
        new = words.difference(self.known)
        again = new.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        return new.difference(again)

    def _learn(self, words: set[bytes]) -> None:
        cut: dict[bytes, list[bytes]] = {}
        pieces: set[bytes] = set()
        for word in words:
            body, end = word[:-1], word[-1:]
            if end in SIGNS and body.isalpha() and body.islower():
                cut[word] = [body, end]
                continue
            if word.isalpha() and word.islower():
                pieces.add(word)
                continue
            text = word.decode()
            if COMMON.fullmatch(text) and "<|" not in text:
                cut[word] = [piece.encode() for piece in PIECES.findall(text.lower())]
            else:
                self.known[word] = _packed(self.full.encode(text, add_special_tokens=False).ids)
        new = list(self._unknown(pieces.union(*cut.values())))
        if new:
            ids = np.array(self.pieces.encode(b" ".join(new).decode(), add_special_tokens=False).ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            data = ids.tobytes()
            bounds = zip([0, *ends.tolist()], ends.tolist(), strict=False)
            self.known.update((piece, data[start:end]) for piece, (start, end) in zip(new, bounds, strict=True))
        known = self.known
        for word, parts in cut.items():
            if word not in known:
                known[word] = b"".join([known[part] for part in parts])


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs one after another, so words are learnt once per worker."""
    return WordEncoder(path)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()
