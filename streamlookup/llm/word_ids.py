"""Token ids of whole texts by the tokenizers library, for vocabularies that drop white space."""

from __future__ import annotations

import re
import struct
from functools import lru_cache

from tokenizers import Tokenizer

from streamlookup.llm.caches import Generations, take_turn

# Bytes of words and ids that a worker remembers, and the longest word it remembers.
CACHED_BYTES = 160 * 1024 * 1024
CACHED_LENGTH = 48

# A word of Latin-1 letters, perhaps with ASCII punctuation behind it other than
# an apostrophe: normalising only changes the letters' case, and letters and
# punctuation are a pre-token each.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")

ID_BYTES = 4


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: its Latin-1
    character if that is printable, else the next unused one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printable)
    return {b: 0x100 + i for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class WordEncoder:
    """Encodes texts as little-endian unsigned 32-bit ids.

    For a vocabulary whose pre-tokenizer drops white space, no token spans a
    blank or a line end, so a text's ids are those of its words in order. The
    library is asked once for a word; a text is then put together from what is
    remembered. Added tokens are found inside words as in the whole text.
    """

    def __init__(self, path: str, cached_bytes: int | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        if self._ids(["a b\nc"]) != [b"".join(self._ids(["a", "b", "c"]))]:
            raise ValueError("the vocabulary keeps white space")
        self.words = Generations(self._word, cached_bytes or CACHED_BYTES, lambda word: len(word) <= CACHED_LENGTH)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [id_bytes(x.ids) for x in found]

    def _word(self, word: str) -> bytes:
        if len(word) <= CACHED_LENGTH and (plain := _PLAIN.fullmatch(word)):
            if plain[2]:
                return self.words[plain[1]] + self.words[plain[2]]
            letters = word.lower()
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(_BYTE_LETTERS)
            return id_bytes([t.id for t in self.tokenizer.model.tokenize(letters)])
        return self._ids([word])[0] if word else b""

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; none for a NULL or empty one."""
        take_turn(self.words)
        ids_of = self.words.__getitem__
        return [b"".join(map(ids_of, (text or "").replace("\n", " ").split(" "))) for text in texts]


def id_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def word_encoder(path: str, cached_bytes: int | None = None) -> WordEncoder:
    """The worker's encoder; what it remembers serves all tasks of the worker."""
    return WordEncoder(path, cached_bytes)
