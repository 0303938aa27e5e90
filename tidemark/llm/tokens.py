"""Token ids of whole texts with a public tokenizer file.

The tokenizer's pre-tokenizer never joins across white space, nor a letter or
digit with ASCII punctuation other than the apostrophe. So a text's ids are its
pieces' ids one after another. Pieces repeat far more often than texts: each is
given to the library once per task and looked up afterwards.
"""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

# Runs of letters and digits, and runs of ASCII punctuation.
PIECE = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\s]+")
# Apostrophes, the library's special strings, the dotted capital I (its lower case has
# a mark of its own) and everything beyond Latin letters: such a text is cut at ASCII
# white space only.
UNSAFE = re.compile(rb"'|<\||[\xc2\xca-\xff]|\xc3[\x97\xb7]|\xc4\xb0")


# Letters alone: one word to the tokenizer, whose last token is marked as the end of a word.
LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")
WORD_END = "</w>"


class WordEncoder:
    """Little-endian unsigned 32-bit ids of texts given as UTF-8 bytes.

    ``most_words`` bounds the memory of the lookup table; beyond it the table
    starts anew, which changes the time, not the ids.
    """

    def __init__(self, path: str, most_words: int = 400_000, words_at_once: int = 200):
        self.tokenizer = Tokenizer.from_file(path)
        # The same model for words of lower-case letters: nothing to normalise, and cut at blanks.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.most_words = most_words
        self.words_at_once = words_at_once
        self.known: dict[bytes, bytes] = {}

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text; the caller bounds the bytes given at once."""
        if len(self.known) > self.most_words:
            self.known = {}
        split = [text.split() if UNSAFE.search(text) else PIECE.findall(text.lower()) for text in texts]
        pieces: set[bytes] = set()
        for run in split:
            pieces.update(run)
        self.learn(list(pieces.difference(self.known)))
        look = self.known.__getitem__
        return [b"".join(map(look, run)) for run in split]

    def learn(self, words: list[bytes]) -> None:
        """Encode words joined by blanks, those of letters apart."""
        plain = [w for w in words if LETTERS.fullmatch(w) and not UNSAFE.search(w)]
        rest = set(words).difference(plain)
        for run, encode in ((plain, self.encode_letters), (list(rest), self.encode_any)):
            for i in range(0, len(run), self.words_at_once):
                encode(run[i : i + self.words_at_once])

    def encode_letters(self, words: list[bytes]) -> None:
        """A word's tokens end with the one that is marked as an end."""
        text = b" ".join(words).decode().lower()
        ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            self.encode_any(words)
            return
        self.note(words, ids, ends)

    def encode_any(self, words: list[bytes]) -> None:
        """A token belongs to the word it starts in."""
        plain = [w.decode() for w in words]
        encoding = self.tokenizer.encode(" ".join(plain), add_special_tokens=False)
        starts = np.array([s for s, _ in encoding.offsets], dtype=np.int64)
        ends = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in plain]))
        self.note(words, np.array(encoding.ids, dtype="<u4"), ends)

    def note(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        data, begin = ids.tobytes(), 0
        for word, end in zip(words, (ends * 4).tolist()):
            self.known[word] = data[begin:end]
            begin = end
