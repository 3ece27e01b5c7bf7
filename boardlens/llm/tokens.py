"""Token ids of whole texts by a public tokenizer file, for the packing and the token files."""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable

MEMO_PIECES = 500_000  # pieces whose ids a Python worker remembers; a speed setting only
MEMO_WORDS = 100_000  # the same for words with other characters
LATIN_END = 0x250  # characters below it have one category in every Unicode version


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)}


def _latin_pieces() -> re.Pattern:
    """The file's own pattern (a fixed value: contractions, runs of letters, single digits, runs of the rest) for Latin text.

    White space is what the tokenizer's pattern takes for it; U+001C to U+001F are none.
    """
    kinds: dict[str, str] = {"L": "", "N": "", "S": ""}
    for c in map(chr, range(LATIN_END)):
        kind = "S" if c in "\t\n\v\f\r \x85\xa0" else unicodedata.category(c)[0]
        if kind in "LN" or c in "\t\n\v\f\r \x85\xa0":
            kinds[kind] += c
    letters, numbers, spaces = (re.escape(kinds[k]) for k in "LNS")
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{spaces}{letters}{numbers}]+")


_PIECES = _latin_pieces()
_ASCII_PIECES = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t\n\v\f\r a-z0-9]+")  # the same for lower-case ASCII
_LATIN = re.compile(f"[\\0-{chr(LATIN_END - 1)}]*")


class WordTokens(dict):
    """Little-endian uint32 ids of texts; the dictionary remembers those of lower-cased pieces between texts and tasks.

    Only for tokenizer files of the ``word_bpe`` kind (composed, lower case, white space dropped), which never join what
    stands on both sides of white space. The library's model merges every distinct piece once. In texts with characters
    beyond Latin ones, or with what may be a special token, the words are taken one by one, and such words go through
    the whole library.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has given the other cores to other tasks
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model.tokenize
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        letters = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        ids = self[piece] = array("I", [t.id for t in self.merge(letters)]).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            lower = word.lower()
            if "<|" in word or not _LATIN.fullmatch(lower):
                ids = array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()
            else:
                ids = b"".join(map(self.__getitem__, _PIECES.findall(lower)))
            self.words[word] = ids
        return ids

    def encode(self, texts: Iterable[str | None], end: int) -> list[bytes]:
        """The ids of each text (null: empty) with ``end`` appended."""
        get, tail, out = self.__getitem__, end.to_bytes(4, "little"), []
        for text in texts:
            lower = text.lower() if text else ""
            if "<|" in lower:
                out.append(b"".join([*map(self._word, text.split(" ")), tail]))
            elif lower.isascii():
                out.append(b"".join([*map(get, _ASCII_PIECES.findall(lower)), tail]))
            elif _LATIN.fullmatch(lower):
                out.append(b"".join([*map(get, _PIECES.findall(lower)), tail]))
            else:
                out.append(b"".join([*map(self._word, text.split(" ")), tail]))
            if len(self) > MEMO_PIECES:
                self.clear()
            if len(self.words) > MEMO_WORDS:
                self.words.clear()
        return out


@functools.cache
def word_tokens(path: str) -> WordTokens:
    """One instance for each file in a Python worker."""
    return WordTokens(path)
