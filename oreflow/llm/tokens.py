"""Token ids of whole texts by a public tokenizer, quick on texts that repeat words."""

from __future__ import annotations

import os
import sys
from types import SimpleNamespace

import numpy as np

# A character that the tokenizer turns into one id when it stands alone: it parts words encoded together.
PART = "\x01"
WORDS_TOGETHER = 256
# Words held for later texts; those met when it is full are encoded each time.
HELD_WORDS = 400_000
LONGEST_HELD = 64

# Texts with these are cut at white space only: marks can combine with a letter, "<|" may begin a special token.
_SPECIAL = (b"<|", b"\xcc", b"\xcd")
_LETTER, _MARK = 1, 2


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[ord("a") : ord("z") + 1] = _LETTER
    for mark in range(ord("!"), 127):
        if not chr(mark).isalnum() and mark != ord("'"):
            table[mark] = _MARK
    return table


class _Words(dict):
    """Word -> number; a word asked for first gets the next number and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Ids of texts, an end id after each, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    For vocabularies of lower-case words that drop white space and merge neither across it nor from letters to
    punctuation.  Texts are cut there, A-Z lowered, and each distinct word goes through the library once while
    it is held; what is held is bounded.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        part = self.tokenizer.encode(PART, add_special_tokens=False).ids
        if len(part) != 1:
            raise ValueError("the tokenizer has no single id for the parting character")
        self.part_id = part[0]
        self.classes = _byte_classes()
        self.words = _Words()
        self.words[None] = 0  # stands for the end of a text
        self.flat = np.array([end_id], np.uint32)
        self.lengths = np.array([1], np.int64)

    def _of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and how many each has."""
        odd = [i for i, w in enumerate(words) if b"\x01" in w]
        if odd:
            # Words with the parting character inside go alone.
            plain = self._of_words([b"" if b"\x01" in w else w for w in words])
            pieces = np.split(plain[0], np.cumsum(plain[1])[:-1])
            for i in odd:
                pieces[i] = np.array(self.tokenizer.encode(words[i].decode(), add_special_tokens=False).ids, np.uint32)
            return np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
        groups = [b" \x01 ".join(words[i : i + WORDS_TOGETHER]) for i in range(0, len(words), WORDS_TOGETHER)]
        encoded = self.tokenizer.encode_batch_fast([g.decode() + f" {PART}" for g in groups], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
        parts = np.flatnonzero(ids == self.part_id)
        if len(parts) != len(words):
            raise ValueError("words came back from the tokenizer in another number")
        return np.delete(ids, parts), np.diff(parts, prepend=-1) - 1

    def _cut(self, text: bytes) -> list[bytes]:
        if any(s in text for s in _SPECIAL):
            return text.split()
        codes = np.frombuffer(text := text.lower(), np.uint8)
        kind = self.classes[codes]
        # Between a letter a-z and a mark, either way round.
        edges = np.flatnonzero(kind[:-1] + kind[1:] == _LETTER + _MARK)
        edges = edges[(kind[edges] > 0) & (kind[edges + 1] > 0)] + 1
        return np.insert(codes, edges, 32).tobytes().split() if len(edges) else text.split()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the length of each text's ids (its end id included)."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        words, counts = [], np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = self._cut(text) if text else []
            counts[i] = len(own) + 1
            words += own
            words.append(None)
        known = len(self.words)
        numbers = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        flat, all_lengths = self.flat, self.lengths
        if new := self.words.new:
            ids, lengths = self._of_words(new)
            flat, all_lengths = np.concatenate([flat, ids]), np.concatenate([all_lengths, lengths])
        starts = np.cumsum(all_lengths) - all_lengths
        lengths = all_lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(starts[numbers] - (ends - lengths), lengths)
        out = flat[at], np.diff(ends[np.cumsum(counts) - 1], prepend=0)
        if new:
            if known + len(new) <= HELD_WORDS and max(map(len, new)) <= LONGEST_HELD:
                self.flat, self.lengths = flat, all_lengths
            else:
                # Numbers must stay without a gap, so what does not fit is forgotten together.
                for word in new:
                    del self.words[word]
            self.words.new = []
        return out


def encoder(path: str, end_id: int) -> Encoder:
    """The worker process's own encoder, kept between its tasks with the words it holds."""
    held = sys.modules.setdefault("_oreflow_encoders", SimpleNamespace(by_key={})).by_key
    if (path, end_id) not in held:
        held[path, end_id] = Encoder(path, end_id)
    return held[path, end_id]
