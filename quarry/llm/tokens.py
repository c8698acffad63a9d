"""Token ids of whole Arrow text batches, through the tokenizers library.

The public word vocabulary lower-cases, drops white space and merges only inside its pre-tokens, so the ids of a
text are those of its parts in order, for any cut at white space or between an ASCII letter or digit and other
ASCII than an apostrophe (contractions hang on that one).  Each distinct part of a batch goes through the
library once, many in one call; frequent parts once per task.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quarry.llm.words import text_bytes

#: Words whose ids a task keeps between batches.
KEPT_WORDS = 400_000
#: Text bytes encoded at once (a longer text alone): distinct words are looked up once in them.
ENCODE_BYTES = 4 << 20


def word_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: Stands between parts in one call; parts that hold it, or a special token's opening, go alone.
_SEPARATOR = "\x01"
_PART_PER_CALL = 500

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 1: ASCII letter or digit, 2: ASCII punctuation other than an apostrophe, 0: all else.
_KIND = np.zeros(256, np.int8)
_KIND[0x21:0x7F] = 2
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x27] = 0


def _spelling() -> dict[int, str]:
    """The byte-level alphabet: the character that stands for each byte (printable Latin-1 for itself)."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


def parted(col: pa.Array) -> pa.Array:
    """The texts with A-Z lower-cased and a space wherever a pre-token surely ends; texts with an opening of a
    special token stay as they are."""
    data, bounds = text_bytes(col)
    if not len(data):
        return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(b""))
    kind = _KIND[data]
    cut = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    low = _LOWER[data]
    opening = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
    for d in np.unique(np.searchsorted(bounds, opening, side="right") - 1).tolist():
        cut[bounds[d]:max(bounds[d], bounds[d + 1] - 1)] = False
        low[bounds[d]:bounds[d + 1]] = data[bounds[d]:bounds[d + 1]]
    at = np.flatnonzero(cut) + 1
    new = bounds + np.searchsorted(at, bounds, side="left")
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(new, np.int64)), pa.py_buffer(np.insert(low, at, 0x20)))


class WordTokenizer:
    def __init__(self, path: str | None = None, kept_words: int = KEPT_WORDS):
        self.kept_words = kept_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path or word_vocabulary())
        self.known: dict[str, bytes] = {}
        mark = self.library.encode(_SEPARATOR, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        #: The model alone takes words of Latin letters below: one pre-token each, nothing to compose.
        self.merge = self.library.model.tokenize
        self.spelt = _spelling()

    def _ids(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, as bytes of unsigned 32-bit numbers."""
        out: list = [None] * len(parts)
        merge, spelt, plain = self.merge, self.spelt, []
        for i, x in enumerate(parts):
            if x.isalpha():
                if x.isascii():
                    out[i] = array("I", [t.id for t in merge(x.lower())]).tobytes()
                    continue
                if max(x) < "\u0180" and "\u0130" not in x:
                    out[i] = array("I", [t.id for t in merge(x.lower().encode().decode("latin-1").translate(spelt))]).tobytes()
                    continue
            if self.mark is not None and _SEPARATOR not in x and "<|" not in x:
                plain.append(i)
        for at in range(0, len(plain), _PART_PER_CALL):
            own = plain[at:at + _PART_PER_CALL]
            ids = np.array(self.library.encode(f" {_SEPARATOR} ".join([parts[i] for i in own]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(own) - 1:
                continue                                        # some part gave the mark itself
            raw = ids.tobytes()
            starts = [0, *(4 * ends + 4).tolist()]
            for i, a, b in zip(own, starts, [*(4 * ends).tolist(), len(raw)], strict=True):
                out[i] = raw[a:b]
        for i, x in enumerate(out):
            if x is None:
                out[i] = np.array(self.library.encode(parts[i], add_special_tokens=False).ids, np.uint32).tobytes()
        return out

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (unsigned 32-bit) of the texts and each text's bounds in them (null: none)."""
        words = pc.ascii_split_whitespace(parted(col))
        offsets = words.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = words.flatten().dictionary_encode()
        if not len(coded):
            return np.zeros(0, np.uint32), np.zeros(len(col) + 1, np.int64)
        names = coded.dictionary.to_pylist()
        get = self.known.get
        ids: list = [get(w) for w in names]
        new = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(new, self._ids([names[i] for i in new]), strict=True):
            ids[i] = x
        if len(self.known) < self.kept_words:
            self.known.update((names[i], ids[i]) for i in new[:self.kept_words - len(self.known)])
        flat = np.frombuffer(b"".join(ids), np.uint32)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.cumsum(size) - size
        code = coded.indices.to_numpy()
        n = size[code]
        ends = np.append(0, np.cumsum(n))
        at = np.repeat(begin[code] - ends[:-1], n) + np.arange(ends[-1])
        return flat[at], ends[offsets]
