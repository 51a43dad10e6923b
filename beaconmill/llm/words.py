"""Words of the public tokenizers, and the ids of one word.

Texts of Latin-1 letters are split by a pattern with explicit classes; for all others the
tokenizer's own splitter is asked, so that the words are the library's in any script.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from tokenizers import Tokenizer

# Letters, numbers and white space among the first 256 code points, and the
# contractions that both vocabularies keep apart.
LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼½¾"
SPACE = "\t-\r \x85\xa0"
SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"

BYTE_WORD = re.compile(
    f"{SUFFIX}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
PLAIN_WORD = re.compile(f"{SUFFIX}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")


@functools.cache
def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Words:
    """One tokenizer file: texts to words, and each word to its ids, encoded once."""

    def __init__(self, path: str, most: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.lower = self.tokenizer.normalizer is not None
        self.pattern = PLAIN_WORD if self.lower else BYTE_WORD
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.mark = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.most = most
        self.known = Known(self)

    def split(self, text: str) -> list[str]:
        """The words of a text, in order; a special token in it is a word of its own."""
        if self.mark is not None and "<|" in text:
            return [w for part in self.mark.split(text) for w in ([part] if part in self.special else self.plain(part))]
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if latin(text):
            return self.pattern.findall(text.lower() if self.lower else text)
        if self.lower:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode_word(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > self.most:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.split(text)))

    def pieces(self) -> list[bytes]:
        """The bytes that each id stands for in a byte-level vocabulary."""
        back = {c: b for b, c in enumerate(byte_letters())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            out[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
        return out


class Known(dict):
    """Ids of the words met so far in this worker; dropped when there are too many."""

    def __init__(self, words: Words):
        super().__init__()
        self.words = words

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = np.array(self.words.encode_word(word), dtype="<u4").tobytes()
        return ids


@functools.cache
def words_of(path: str) -> Words:
    """One per worker process and file."""
    return Words(path)
