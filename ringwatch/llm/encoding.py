"""Token ids by the public tokenizers, one model call per distinct word.

The library's ``encode`` keeps alignments of every character, which costs most
of its time. Here a text of plain Latin characters is cut into words by the
tokenizer's own pattern, and the library's model segments each distinct word
once per worker; any other text, and any that holds the string of an added token
(``<|endoftext|>``, which keeps its own id), goes through ``encode`` whole. Both
give the same ids (tests compare them).
"""

from __future__ import annotations

import re
from array import array

import numpy as np

#: Words of one generation of a worker's table; the table holds the newest two. Byte-level words
#: come with and without a space and in either case, so there are more of them.
GENERATION = {"byte_bpe_50k.json": 400_000, "word_bpe_49k.json": 300_000}

_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_OTHER = f"[^ \\t-\\r0-9{_LETTERS}]"
_PATTERNS = {
    # The word patterns of the two tokenizer files, for plain Latin characters.
    "byte_bpe_50k.json": f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?{_OTHER}+|[ \\t-\\r]+(?![^ \\t-\\r])|[ \\t-\\r]+",
    "word_bpe_49k.json": f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|{_OTHER}+",
}
_LOWER = {"word_bpe_49k.json"}
#: Bytes (in Latin-1) of the characters for which the patterns above hold.
_PLAIN = bytes([*range(9, 14), *range(32, 127), *range(0xC0, 0x100)])


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte, as byte-level vocabularies write it: printable bytes stand
    for themselves, the others for the letters from U+0100 on, in byte order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return {b: chr(b if b in own else next(other)) for b in range(256)}


class Encoder(dict):
    """Maps a word to the little-endian 32-bit ids of its pieces; ``ids(text)`` gives a text's.

    The table is the young generation. When it is full it becomes the old one;
    a word found there moves on, so words in use stay and rare ones go.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
        self.model = self.tokenizer.model
        self.words = re.compile(_PATTERNS[name]).findall
        self.lower = name in _LOWER
        self.letters = byte_letters()
        self.old: dict[str, bytes] = {}
        self.generation = GENERATION[name]

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            spelled = word.encode().decode("latin-1").translate(self.letters)
            out = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        if len(self) >= self.generation:
            self.old = dict(self)
            self.clear()
        self[word] = out
        return out

    def ids(self, text: str) -> bytes:
        try:
            plain = not text.encode("latin-1").translate(None, _PLAIN)
        except UnicodeEncodeError:
            plain = False
        if not plain or self.added(text):
            text = text.encode("utf-8", "replace").decode()
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, self.words(text.lower() if self.lower else text)))


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
