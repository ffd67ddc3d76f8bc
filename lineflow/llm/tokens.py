"""Token ids of whole texts by a public tokenizer file, with words looked up in a table.

A word-level tokenizer gives a word the same ids wherever it stands, so each task keeps
the ids of the words it has seen and asks the library about new words only. Where words
don't cross white space, texts are split there and before stops, and the pattern splits only
what is new and not letters alone. Texts with characters for which Python's splitting might
differ go to the library whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: Words whose ids a worker keeps; then it starts afresh.
KNOWN_WORDS = 400_000
#: Characters that are split at a time; longer texts are cut at white space.
PIECE = 1 << 20
#: Characters that Python and the library lower-case, split and normalise alike.
_PLAIN = re.compile(r"[\t-\r\x20-\x7eÀ-ÿ]*")
_SPACE = re.compile(r"[\t-\r ]")
#: A pattern whose words don't cross white space, and stops that are no words of their own by it, as signs before them belong to the word.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_RUN = re.compile(r"[.,](?<=[!-/:-@\[-`{-~×÷].)")
_LAST = object()
#: End-of-document id.
END = 1


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.split, self.known = self._splitter(spec), {}
        if self.split:
            self.spaced = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == _WORDS
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            self.special = [t["content"] for t in spec["added_tokens"]]

    @staticmethod
    def _splitter(spec: dict) -> re.Pattern | None:
        """The word pattern for plain texts, if the file is of the kind that allows it."""
        try:
            normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
            split, level = spec["pre_tokenizer"]["pretokenizers"]
            fits = normal == ["NFC", "Replace", "Lowercase"] and split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]
            fits = fits and level["type"] == "ByteLevel" and not level["use_regex"] and not level["add_prefix_space"]
            if not fits or not spec["model"]["end_of_word_suffix"]:
                return None
            pattern = split["pattern"]["Regex"]
        except (KeyError, TypeError, ValueError):
            return None
        return re.compile(pattern.replace(r"\p{L}", "a-zß-öø-ÿ").replace(r"\p{N}", "0-9"))

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw, cuts = ids.tobytes(), [0, *(ends * self.width).tolist()]
                self.known.update((w, raw[a:b]) for w, a, b in zip(part, cuts, cuts[1:]))
            else:
                for word, found in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False)):
                    self.known[word] = np.array(found.ids, self.dtype).tobytes()

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            end = at + PIECE
            if end < len(text):
                space = _SPACE.search(text, end)
                end = space.start() if space else len(text)
            yield text[at:end]
            at = end

    def _whole(self, piece: str) -> bytes:
        return np.array(self.library.encode_batch_fast([piece], add_special_tokens=False)[0].ids, self.dtype).tobytes()

    def _chunks(self, text: str) -> list[str]:
        """Words of a plain text, or chunks of whole words."""
        if not self.spaced or _RUN.search(text):
            return self.split.findall(text)
        return text.replace(".", " .").replace(",", " ,").split()

    def _looked_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; new words of all pieces are learned at once."""
        plain = [self.split is not None and bool(_PLAIN.fullmatch(p)) and not any(s in p for s in self.special) for p in pieces]
        chunks = [self._chunks(p.lower()) if fits else [] for p, fits in zip(pieces, plain)]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        new = set().union(*chunks).difference(self.known)
        made = {c: words for c in new if not c.isalpha() and (words := self.split.findall(c)) != [c]} if self.split and self.spaced else {}
        if made:
            new = new.difference(made).union(set().union(*made.values()).difference(self.known))
        self._learn(list(new))
        get = self.known.__getitem__
        self.known.update([(c, b"".join(map(get, words))) for c, words in made.items()])
        return [b"".join(map(get, c)) if fits else self._whole(p) for p, c, fits in zip(pieces, chunks, plain)]

    def documents(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """For each text its ids and the end id, as little-endian integers of self.width bytes."""
        end, held, counts, size = self.dtype.type(END).tobytes(), [], [], 0
        for text in itertools.chain(texts, [_LAST]):
            if text is not _LAST:
                pieces = list(self._pieces(text or ""))
                held += pieces
                counts.append(len(pieces))
                size += len(text or "")
            if size > PIECE or text is _LAST:
                found = iter(self._looked_up(held))
                for n in counts:
                    yield np.frombuffer(b"".join([*itertools.islice(found, n), end]), self.dtype)
                held, counts, size = [], [], 0

    def document(self, text: str | None) -> np.ndarray:
        return next(self.documents([text]))


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and word table for each worker process."""
    return WordTokenizer(path)
