"""Exact token ids of whole texts, encoded once per distinct piece of text.

The tokenizer cuts texts at white space before anything else, so the ids of a text are those of its
pieces between ASCII white space, one after another.  A task encodes every distinct piece once and
keeps it in a cache of its worker, which later tasks of that worker go on with.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillhouse.llm.texts import strings

#: Pieces a worker's cache holds before it is emptied.
CACHE_PIECES = 1_500_000
#: Punctuation that may be cut from the end of a piece: it always forms a token run of its own after a letter or digit.
TAIL = ".,;:!?*#$%&|"
#: Words encoded in one call.
TOGETHER = 512

_loaded: dict[str, Encoder] = {}


def lowered(texts: pa.Array) -> pa.Array:
    """Lower A-Z as the tokenizer would, so that fewer pieces differ; not where a special token may stand."""
    return pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))


def is_word(piece: str) -> bool:
    """Letters only, also after the tokenizer's normalisation: one run of letters, one token sequence."""
    if piece.isascii():
        return piece.isalpha()
    return piece.isalpha() and piece.lower().isalpha() and unicodedata.is_normalized("NFC", piece)


class Encoder:
    """A tokenizer that lowers case and marks word ends, and the ids of the pieces this worker has met.

    Entry ``i`` holds ``size[i]`` ids of ``flat`` from ``begin[i]``; entry 0 is the empty piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.size = np.zeros(1, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text by the tokenizer itself."""
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has: many words are encoded as one text and told apart by their end marks."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), TOGETHER):
            some = words[i:i + TOGETHER]
            flat = self.encode([" ".join(some)])[0]
            stops = np.flatnonzero(self.ends_word[flat]) + 1
            if len(stops) != len(some):
                own = self.encode(some)
                flat, stops = np.concatenate(own), np.cumsum([len(x) for x in own])
            ids.append(flat)
            sizes.append(np.diff(stops, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    def learn(self, missing: list[str]) -> None:
        """Add entries for new pieces."""
        words, others = [], []
        for piece in missing:
            (words if is_word(piece) else others).append(piece)
        ids, sizes = self.encode_words(words)
        rest = [x for i in range(0, len(others), 4096) for x in self.encode(others[i:i + 4096])]
        sizes = np.concatenate([sizes, np.fromiter(map(len, rest), np.int64, len(rest))])
        self.known.update(zip(words + others, range(len(self.size), len(self.size) + len(sizes))))
        self.size = np.concatenate([self.size, sizes])
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat = np.concatenate([self.flat, ids, *rest])  # one copy per slice of text, small beside encoding

    def entries(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Two entries per piece: what is left of its ids, and the punctuation cut from its end (often entry 0)."""
        if len(self.known) > CACHE_PIECES:
            self.forget()
        trimmed = pc.utf8_rtrim(vocabulary, TAIL)
        heads, tails = strings(trimmed), {}
        cut = np.flatnonzero(np.asarray(pc.not_equal(pc.binary_length(trimmed), pc.binary_length(vocabulary))))
        for i, piece in zip(cut.tolist(), strings(vocabulary.take(pa.array(cut)))):
            head = heads[i]
            if head and head[-1].lower()[-1].isalnum() and "<|" not in piece:
                tails[i] = piece[len(head):]
            else:
                heads[i] = piece
        second = np.zeros(len(heads), np.int64)
        second[list(tails)] = self._indices(list(tails.values()))
        return self._indices(heads), second

    def _indices(self, names: list[str]) -> np.ndarray:
        """The entry of each piece; unknown ones are learnt."""
        found = list(map(self.known.get, names))
        missing = [i for i, entry in enumerate(found) if entry is None]
        if missing:
            self.learn(list({names[i] for i in missing}))
            for i in missing:
                found[i] = self.known[names[i]]
        return np.array(found, np.int64)

    def ids_of(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and for each piece where its ids begin and how many there are."""
        both = np.stack(self.entries(vocabulary), axis=1)
        each = self.size[both].ravel()
        at = np.arange(int(each.sum())) + np.repeat(self.begin[both].ravel() - (np.cumsum(each) - each), each)
        size = self.size[both].sum(axis=1)
        return self.flat[at], np.cumsum(size) - size, size

    def lengths_of(self, vocabulary: pa.Array) -> np.ndarray:
        """Number of ids of each piece."""
        heads, tails = self.entries(vocabulary)
        return self.size[heads] + self.size[tails]


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
