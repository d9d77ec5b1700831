"""Encoding by public tokenizers inside tasks, with the ids of known pieces of text remembered."""

from __future__ import annotations

import os
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN_PIECES = 400_000  # remembered pieces of text
KNOWN_LETTERS = 64  # longer pieces are encoded each time


def tokenizer_path(name: str) -> str:
    """A file path as it is, a bare file name among the installed vocabularies."""
    if os.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load_tokenizer(name: str, specials_are_text: bool = False):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel unit
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(name))
    if specials_are_text:
        t.encode_special_tokens = True
    return t


@lru_cache(maxsize=4)
def load_pieces(name: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes the 256 bytes: printable Latin-1
    letters stand for themselves, the others for U+0100 onward in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


class Remembered:
    """Results of ``encode`` (list of pieces -> list of results), by piece.  Holds the pieces asked for last, at least
    ``limit`` and at most twice as many beside those of one call."""

    def __init__(self, encode, limit: int = KNOWN_PIECES):
        self.encode, self.limit, self.known, self.before, self.long = encode, limit, {}, {}, []

    def __call__(self, pieces: set[str]) -> dict:
        """A dict that holds the results of ``pieces`` at least, until the next call."""
        for p in self.long:
            self.known.pop(p, None)
        if len(self.known) > self.limit:
            self.known, self.before = {}, self.known
        known, before, new = self.known, self.before, []
        for p in pieces:
            if p not in known:
                if p in before:
                    known[p] = before[p]
                else:
                    new.append(p)
        known.update(zip(new, self.encode(new)))
        self.long = [p for p in new if len(p) > KNOWN_LETTERS]
        return known


class WordIds:
    """Ids of texts under a tokenizer that lowers letters and parts white space, letters and marks, as little-endian 32-bit
    numbers.  It treats what stands between blanks or line feeds apart, so that each such piece is encoded once,
    and of a word with marks behind it the word and the marks."""

    MARKS = ".,;:!?#$%&*"  # none that ends a special token

    def __init__(self, name: str):
        self.tokenizer = load_tokenizer(name)
        self.letters = {b: letter for letter, b in byte_letters().items()}
        self.pieces = Remembered(self._encode)
        self.marks = lru_cache(maxsize=10_000)(lambda marks: self._whole([marks])[0])

    def _whole(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _encode(self, pieces: list[str]) -> list[bytes]:
        tokenize, letters, out, rest = self.tokenizer.model.tokenize, self.letters, [], []
        for p in pieces:
            word = p.rstrip(self.MARKS)
            if word.isalpha() and (word.isascii() or max(word) <= "ÿ") and len(p) <= KNOWN_LETTERS:
                low = word.lower()  # neither normalised nor parted by the tokenizer
                ids = [t.id for t in tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(letters))]
                own = pack(f"<{len(ids)}I", *ids)
                out.append(own + self.marks(p[len(word):]) if len(word) < len(p) else own)
            else:
                rest.append(len(out))
                out.append(b"")
        for at, own in zip(rest, self._whole([pieces[at] for at in rest])):
            out[at] = own
        return out

    def of(self, texts: pa.Array) -> tuple[np.ndarray, memoryview]:
        """The ids of all texts (strings, null: empty) in one run, and at which bytes of it each text begins and the last ends."""
        pieces = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        numbered = pieces.values.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.pieces(distinct)
        ids = pa.array([known[p] for p in distinct], pa.large_binary()).take(numbered.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)
        return ends[pieces.offsets.to_numpy()], memoryview(ids.buffers()[2] or b"")

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        at, ids = self.of(pa.array(texts, pa.string()))
        return [bytes(ids[lo:hi]) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]


@lru_cache(maxsize=1)
def word_ids(name: str) -> WordIds:
    """One memory for all tasks of a worker process."""
    return WordIds(name)
