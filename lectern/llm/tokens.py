"""Whole texts to ids of a public tokenizer, with what words become remembered.

The tokenizer never joins across white space, so a text's ids are those of its words one after the other. Words are
numbered. Of those that are not remembered yet, words of ASCII and Latin-1 letters are cut by the tokenizer's own
pattern and given to its model; any other goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .common import bytes_hashes

#: Words that are remembered; then it starts anew.
REMEMBERED = 400_000
#: Words without anything that the tokenizer normalises but for case, and what its pattern cuts there.
_PLAIN = re.compile("[!-;=-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on.
_SELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_STAND_FOR = {b: b for b in _SELF} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SELF)))}


def _room(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


class WordIds(dict):
    """Numbers of lower-case words; and by number each word's ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        said = self.tokenizer.to_str()
        self.plain = '"end_of_word_suffix":"</w>"' in said and '"Lowercase"' in said
        self.anew()

    def anew(self) -> None:
        """Forgets all words: their numbers no longer hold."""
        self.clear()
        self.asked: list[bytes] = []
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.flat, self.starts, self.known = np.empty(1024, self.dtype), np.zeros(1024, np.int64), 0

    def full(self) -> bool:
        return len(self) > REMEMBERED

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __missing__(self, word: bytes) -> int:
        self.asked.append(word)
        self[word] = n = len(self)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word."""
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.asked:
            self._learn()
        return out

    def _learn(self) -> None:
        asked, self.asked = self.asked, []
        pieces, tokenize, plain, cut = self.pieces, self.tokenizer.model.tokenize, _PLAIN.fullmatch, _PIECES.findall
        if len(pieces) > REMEMBERED // 2:
            pieces.clear()
        new: list[int] = []
        ends = []
        for word in b" ".join(asked).decode("utf-8", "replace").split(" "):
            if not self.plain or not plain(word):
                new += self._ids(word)
            else:
                for p in cut(word.lower()):
                    if (got := pieces.get(p)) is None:
                        own = p if p.isascii() else p.encode().decode("latin-1").translate(_STAND_FOR)
                        got = pieces[p] = tuple([t.id for t in tokenize(own)])
                    new += got
            ends.append(len(new))
        n, at = self.known, int(self.starts[self.known])
        self.flat = _room(self.flat, at + len(new))
        self.starts = _room(self.starts, n + len(asked) + 1)
        self.flat[at : at + len(new)] = new
        self.starts[n + 1 : n + len(asked) + 1] = at + np.array(ends)
        self.known += len(asked)

    def hashes(self) -> np.ndarray:
        """Of each word by number."""
        words = list(self)
        return np.concatenate([np.empty(0, np.uint64), *(bytes_hashes(b" ".join(words[k : k + 50_000])) for k in range(0, len(words), 50_000))])

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words by number, one after the other; and how many each has."""
        starts = self.starts[numbers]
        n = self.starts[numbers + 1] - starts
        ends = np.cumsum(n)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + n, n)], n

    def texts(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, one after the other, and how many each has; null: none."""
        own: list[list[bytes] | np.ndarray] = []
        for t in texts:
            if t and (b"<" in t or b"\xcc" in t or b"\xcd" in t):  # special tokens are not lower-cased; marks join their letter first
                own.append(np.array(self._ids(t.decode("utf-8", "replace")), self.dtype))
            else:
                own.append(t.lower().split() if t else [])
        if self.full():
            self.anew()
        ids, n = self.ids_of(self.numbers([w for x in own if isinstance(x, list) for w in x]))
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum([len(x) for x in own if isinstance(x, list)], dtype=np.int64))]
        parts = iter([ids[a:b] for a, b in zip(ends, ends[1:], strict=False)])
        out = [next(parts) if isinstance(x, list) else x for x in own]
        return np.concatenate([np.empty(0, self.dtype), *out]), np.array([len(x) for x in out], np.int64)

    def text(self, text: bytes | None) -> bytes:
        """Ids of one whole text; null: none."""
        return self.texts([text])[0].tobytes()


_OPEN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each Python worker, kept between its tasks."""
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]
