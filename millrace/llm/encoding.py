"""Token ids of whole texts by the tokenizers library, word by word.

The vocabulary at hand pre-tokenizes at white space, so the ids of a text are those of its words in
turn, and a word needs encoding once. ``WordEncoder`` keeps the words it has met, a bounded number of
them; the library encodes the others. A word of Latin letters and the signs of ASCII falls into pre-tokens by
the vocabulary's own pattern, and each, kept like words are, goes straight to the library's BPE model.
"""

from __future__ import annotations

import re
import struct
import sys
from array import array

KEPT_WORDS = 400_000
# Words that the library's normalizer only lower-cases, "<|" (special tokens) aside, and the pattern of
# the vocabulary's pre-tokenizer among their characters.
PLAIN = re.compile(r"(?:(?!<\|)[!-~À-ÖØ-öø-ÿ])+")
PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# Four bytes on every machine, in the machine's order.
UNSIGNED = next(code for code in "IL" if array(code).itemsize == 4)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    if sys.byteorder == "little":
        return array(UNSIGNED, ids).tobytes()
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder(dict):
    """Ids of a word (UTF-8 bytes) as little-endian 32-bit numbers; encodes what it has not met."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.kept_words = kept_words
        # The library's own spelling of the 256 bytes as characters.
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {
            code: "".join(piece for piece, _ in spell.pre_tokenize_str(chr(code)))[-1]
            for code in range(128)
        }
        for code in range(128, 256):
            lead = 0xC2 if code < 0xC0 else code
            self.spelling.setdefault(code, None)
            if code < 0xC0:
                self.spelling[code] = spell.pre_tokenize_str(bytes([lead, code]).decode())[0][0][1]
        for code in (0xC2, 0xC3):
            self.spelling[code] = spell.pre_tokenize_str(bytes([code, 0xA9]).decode())[0][0][0]

    def _encode(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _pre_token(self, text: str) -> bytes:
        # Characters of ASCII, white space aside, are spelled as themselves.
        spelled = text if text.isascii() else text.encode().decode("latin-1").translate(self.spelling)
        return packed([token.id for token in self.tokenizer.model.tokenize(spelled)])

    def __missing__(self, word: bytes) -> bytes:
        # Words, and as many pre-tokens that are no words.
        if len(self) >= 2 * self.kept_words:
            self.clear()
        text = word.decode()
        if PLAIN.fullmatch(text):
            parts = PRE_TOKENS.findall(text.lower())
            if parts[0] == text:
                ids = self._pre_token(text)
            else:
                ids = b"".join([self[part.encode()] for part in parts])
        else:
            ids = self._encode(text)
        self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, as little-endian 32-bit numbers."""
        return b"".join(map(self.__getitem__, (text or "").encode().split()))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)
