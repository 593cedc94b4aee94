"""Token ids of whole texts by a public tokenizer file, through a cache of words.

White space separates the words of this vocabulary, so a text's ids are its
words' ids one after another; each distinct word is tokenized once per worker.
Words of ASCII and Latin letters, digits and signs are split by the vocabulary's
own pattern and given to its merge model; all others go through the whole
tokenizer.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

#: Visible ASCII and Latin letters up to U+017E, without the one that lower-casing makes two characters.
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ž]+")
#: Fixed value: the vocabulary's split pattern (contractions, letters, single digits, signs), for lower-cased plain words.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-zß-öø-ž0-9]+")


class WordIds(dict):
    """word (UTF-8) -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, max_words: int = 700_000):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.tokenizer, self.max_words = Tokenizer.from_file(path), max_words
        self.model, self.parts = self.tokenizer.model, {}
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x21, 0x180) if PLAIN.fullmatch(chr(c))]
        self.alphabet = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in letters}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and "<|" not in text:
            ids = b"".join([self.parts.get(p) or self.part(p) for p in SPLIT.findall(text.lower())])
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[word] = ids
        return ids

    def part(self, part: str) -> bytes:
        tokens = self.model.tokenize(part.translate(self.alphabet))
        ids = self.parts[part] = np.array([t.id for t in tokens], dtype="<u4").tobytes()
        return ids

    def encode(self, text: bytes) -> bytes:
        """The ids of a whole text, as bytes."""
        if len(self) > self.max_words:  # only the cache is bounded, not what is tokenized
            self.clear()
        if len(self.parts) > self.max_words:
            self.parts.clear()
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker and vocabulary file."""
    return WordIds(path)
