"""Token ids of many texts at once, with the tokenizers library.

The vocabulary file drops white space, so ids can be found chunk by chunk
between ASCII white space.  Chunks repeat a lot: each batch is split and
reduced to its different chunks in Arrow, and only those are looked up.  A
chunk of letters, digits and marks that the library's normalizer only lower-
cases is cut by the vocabulary's own pre-token pattern and encoded by the
library's model; every other chunk goes through the whole library.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the pre-token pattern of the vocabulary, for the characters
#: that SAFE allows.
PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
#: Chunks that the normalizer only lower-cases: printable ASCII and the
#: letters of Latin-1.
SAFE = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]*")
#: Special strings of the vocabulary start with it.
SPECIAL = "<|"
#: Most chunks a worker remembers (Arrow strings and ids, some 40 bytes each),
#: and most pre-tokens (Python objects, some 200 bytes each).
REMEMBERED, WORDS = 800_000, 200_000
#: Bytes of text that are split at once.
AT_ONCE = 4 << 20


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """``encode`` gives the ids of each text, end to end in one array."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids = np.empty(0, "u4")
        self.first = np.zeros(0, "i4")     # where each known chunk's ids start
        self.size = np.zeros(0, "i4")      # and how many they are

    def _word(self, word: str) -> list[int]:
        got = self.words.get(word)
        if got is None:
            text = word if word.isascii() else self.to_bytes.pre_tokenize_str(word)[0][0]
            got = [t.id for t in self.model.tokenize(text)]
            if len(self.words) >= WORDS:
                self.words.clear()
            self.words[word] = got
        return got

    def chunk(self, chunk: str) -> list[int]:
        """The ids of a text without ASCII white space."""
        if chunk.isascii() and chunk.isalpha():
            return self._word(chunk.lower())
        if SAFE.fullmatch(chunk) and SPECIAL not in chunk:
            out: list[int] = []
            for word in PRE_TOKENS.findall(chunk.lower()):
                out += self._word(word)
            return out
        return self.library.encode(chunk, add_special_tokens=False).ids

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """The number of each chunk among the known ones; new ones are encoded."""
        places = pc.index_in(chunks, value_set=self.known)
        if not places.null_count:
            return places.to_numpy(zero_copy_only=False)
        missing = pc.is_null(places)
        coded = chunks.filter(missing).dictionary_encode()
        new = coded.dictionary
        if len(self.known) + len(new) > self.remembered and len(self.known):
            self._forget()
            return self._places(chunks)
        ids, size = [], []
        for c in new.to_pylist():
            got = self.chunk(c)
            ids += got
            size.append(len(got))
        size = np.asarray(size, "i4")
        out = pc.fill_null(places, 0).to_numpy(zero_copy_only=False).copy()
        out[missing.to_numpy(zero_copy_only=False)] = len(self.known) + coded.indices.to_numpy()
        self.first = np.concatenate([self.first, (len(self.ids) + np.cumsum(size) - size).astype("i4")])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, np.asarray(ids, "u4")])
        self.known = pa.concat_arrays([self.known, new])
        return out

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lower = pc.ascii_lower(texts)
        if pc.any(pc.match_substring(lower, SPECIAL)).as_py():
            lower = texts       # special strings are told apart by their case
        split = pc.ascii_split_whitespace(lower)
        ends = split.offsets.to_numpy().astype("i8")
        ends -= ends[0]
        which = self._places(split.flatten())
        size = self.size[which]
        stop = np.zeros(len(size) + 1, "i4" if len(which) < 1 << 27 else "i8")
        np.cumsum(size, out=stop[1:])
        at = np.repeat(self.first[which] - stop[:-1], size)
        at += np.arange(stop[-1], dtype=at.dtype)
        return self.ids[at], stop[ends]

    def encode(self, texts: pa.Array):
        """Yield (first text, ids, starts): the ids of texts first .. first +
        len(starts) - 2, text i's being ids[starts[i]:starts[i + 1]]."""
        for at, some in pieces(texts, AT_ONCE):
            yield at, *self._encode(some)


def unsliced(texts: pa.Array) -> pa.Array:
    """A large_string array without NULLs whose offsets start at 0 (Arrow's
    string functions misread some sliced arrays)."""
    if len(texts) == 0:
        return pa.array([], pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, "i8")[texts.offset:texts.offset + len(texts) + 1]
    data = data.slice(at[0], at[-1] - at[0]) if data is not None else pa.py_buffer(b"")
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((at - at[0]).tobytes()), data)


def pieces(texts: pa.Array, size: int = 3 << 20):
    """Yield (first, texts) in runs of about ``size`` bytes, NULL as empty, so
    that what is held for a run does not grow with a batch."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype="i8")])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield at, unsliced(texts.slice(at, to - at).cast(pa.large_string()).fill_null(""))
        at = to


def row_slices(batch: pa.RecordBatch, column: int, size: int = 4 << 20):
    """The batch in runs of rows with about ``size`` bytes of text."""
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(length, dtype="i8")])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


@functools.lru_cache(maxsize=2)
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One per worker and vocabulary: what it remembers outlives a task."""
    return Encoder(path, remembered)
