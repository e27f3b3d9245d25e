"""Whole texts to token ids with a public tokenizer, inside a task.

The byte-level pre-tokenizer always starts a new piece at a space that is
followed by a non-space character, and merges never cross pieces. So a text can
be cut at such spaces and the ids of the parts joined: the result is exactly
that of encoding the whole text. Parts repeat a lot, so a worker keeps the ids
of up to ``limit`` of them; only new parts reach the tokenizer.

The ids are those of the library's call with ``add_special_tokens=False`` and nothing else set: the string
of an added token (``<|endoftext|>``) in a text is that token. Such tokens may take spaces beside them, so a text that holds
one goes through the library whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
# After a space, these characters are certainly no white space (ASCII marks and Latin letters).
_SOLID = re.compile("[!-~¡-ɏ]")
# Letters that every Unicode version has as such, and ASCII marks after them.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ƺ]+)([!-/:-@\[-`{-~]*)")
_LONGEST = 48


def _byte_letters() -> dict[int, str]:
    """The letter that stands for a byte in a byte-level vocabulary: printable Latin-1 characters stand for
    themselves, the others take the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


_BYTES = _byte_letters()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """``encode(texts)`` gives, per text, its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, limit: int = 800_000):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values() if t.content]
        self._known: dict[str, bytes] = {}
        self._limit = limit
        self._model = self._tok.model
        self._marks = lru_cache(maxsize=4096)(lambda marks: self.direct([marks])[0])

    def direct(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str], end: bytes = b"") -> list[bytes]:
        """The ids of each text, followed by ``end``."""
        whole = [k for k, t in enumerate(texts) if any(a in t for a in self._added)]
        if whole:
            held, texts = [texts[k] for k in whole], list(texts)
            for k in whole:
                texts[k] = ""
            out = self._parts(texts, end)
            for k, ids in zip(whole, self.direct(held)):
                out[k] = ids + end
            return out
        return self._parts(texts, end)

    def _parts(self, texts: list[str], end: bytes) -> list[bytes]:
        """The same for texts without the string of an added token, by parts."""
        heads, rests = [], []
        for t in texts:
            head, space, rest = t.partition(" ")
            heads.append(head)
            rests.append(rest if space else None)
        heads = self.direct(heads)
        # All parts of the batch, each different one looked up once.
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        parts = pc.list_flatten(lists).dictionary_encode()
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids, missing = list(map(self._known.get, words)), []
        odd = np.zeros(len(words), bool)             # what has to be joined to the part before it
        for k, x in enumerate(ids):
            if x is None:
                if _SOLID.match(words[k]):
                    missing.append(k)
                else:
                    odd[k], ids[k] = True, b""
        self._learn(words, ids, missing)
        index = parts.indices.to_numpy()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        # The taken parts lie one after another in one buffer: a text's ids are a stretch of it.
        _, places, data = pa.array(ids, pa.large_binary()).take(parts.indices).buffers()
        places = np.frombuffer(places, np.int64)[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        data = memoryview(data or b"")
        out = [b"".join((h, data[a:z], end)) for h, a, z in zip(heads, places, places[1:])]
        if odd.any():
            row = np.repeat(np.arange(len(texts)), sizes)
            for k in np.unique(row[odd[index]]).tolist():
                out[k] = self._odd(texts[k]) + end
        return out

    def _learn(self, words: list[str], ids: list, missing: list[int]) -> None:
        """Fill in the ids of parts that are not known as they are; keep new ones while there is room.

        Letters and marks after them are different pieces, and letters alone are one piece, which
        goes to the tokenizer's model as it is. All other parts go through the whole tokenizer.
        """
        known, limit, other = self._known, self._limit, {}
        for k in missing:
            m = _WORD.fullmatch(words[k])
            if m is None:
                other.setdefault(words[k], []).append(k)
                continue
            word, marks = m.groups()
            x = known.get(word)
            if x is None:
                mapped = (" " + word).encode().decode("latin-1").translate(_BYTES)
                x = array("I", [t.id for t in self._model.tokenize(mapped)]).tobytes()
                if len(word) <= _LONGEST and len(known) < limit:
                    known[word] = x
            ids[k] = x + self._marks(marks) if marks else x
        for (w, places), x in zip(other.items(), self.direct([" " + w for w in other])):
            for k in places:
                ids[k] = x
            if len(w) <= _LONGEST and len(known) < limit:
                known[w] = x

    def _odd(self, text: str) -> bytes:
        """A text with longer runs of white space, part by part."""
        head, *rest = text.split(" ")
        head, rest = _joined(head, rest)
        ids = list(map(self._known.get, rest))
        self._learn(rest, ids, [k for k, x in enumerate(ids) if x is None])
        return self.direct([head])[0] + b"".join(ids)


def _joined(head: str, parts: list[str]) -> tuple[str, list[str]]:
    """The same split without the spaces that belong to a longer run of white space."""
    out = [head]
    for p in parts:
        if _SOLID.match(p):
            out.append(p)
        else:
            out[-1] += " " + p
    return out[0], out[1:]


def pieces(batch: pa.RecordBatch, rows: int = 1024, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``rows`` rows and about ``size`` characters of ``text`` (or one longer text)."""
    chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy()
    start, held = 0, 0
    for i, n in enumerate(chars.tolist()):
        if i > start and (held + n > size or i - start == rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows:
        yield batch.slice(start)


@cache
def n_symbols(path: str) -> int:
    """Ids of the vocabulary, added tokens included: one more than the largest."""
    from tokenizers import Tokenizer
    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1


@cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path)
