"""Byte-level BPE ids with a bounded cache of word encodings in each worker.

A byte-level BPE encodes each pre-token alone, so ids of a text are the ids of its
pre-tokens in order. Texts of plain Latin characters are split here and each distinct
word goes to the tokenizer once; any other text, and any that holds one of the
vocabulary's added tokens, goes to the tokenizer whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import compress
from operator import not_

import numpy as np

#: Words whose ids a worker remembers at most (about 100 MB).
CACHE_WORDS = 500_000
#: Texts that are encoded at a time.
SLICE = 256

_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\\t\\n\\r \xa0"
#: Characters for which the classes above say all there is to say.
_plain = re.compile("[\\t\\n\\r\x20-\x7e\xa0-ɏ‐-‧]*").fullmatch
#: The vocabulary's pre-token pattern over those characters.
_pieces = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
).findall

_encoders: dict[str, BpeEncoder] = {}


class BpeEncoder:
    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        # the split by ``_pieces`` holds for a vocabulary of this normalizer and pre-tokenizer alone; any other gets whole texts
        split = made["pre_tokenizer"] or {}
        self.splits = made["normalizer"] is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, encoded in one call and joined by line ends where that splits them alike."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if not w.isspace()]
        if plain:
            joined = self.tokenizer.encode("\n".join(plain), add_special_tokens=False)
            place = np.array(joined.word_ids, dtype=np.int64)
            if len(place) and place[-1] == 2 * len(plain) - 2:
                raw = np.array(joined.ids, dtype="<u4").tobytes()
                cuts = (4 * np.searchsorted(place, np.arange(2 * len(plain)))).tolist()
                out = {w: raw[cuts[2 * i] : cuts[2 * i + 1]] for i, w in enumerate(plain)}
        for w in words:
            if w not in out:
                out[w] = self._whole(w)
        return out

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text (null: none) as uint32."""
        known = self.known
        for at in range(0, len(texts), SLICE):
            some = texts[at : at + SLICE]
            split = [(_pieces(t) if self.splits and _plain(t) and not any(a in t for a in self.added) else None) if t else [] for t in some]
            raws = [list(map(known.get, w)) if w else w for w in split]
            # places of words that aren't known yet: ids of a word are never empty
            gaps = [list(compress(range(len(r)), map(not_, r))) if r else () for r in raws]
            new = {words[i] for words, gap in zip(split, gaps, strict=True) for i in gap}
            found = self._words(list(new)) if new else {}
            for text, words, raw, gap in zip(some, split, raws, gaps, strict=True):
                if words is None:
                    yield np.frombuffer(self._whole(text), dtype="<u4")
                    continue
                for i in gap:
                    raw[i] = found[words[i]]
                yield np.frombuffer(b"".join(raw), dtype="<u4")
            if len(known) + len(found) <= CACHE_WORDS:
                known.update(found)


def encoder(path: str) -> BpeEncoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = BpeEncoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def crc32_of(ids: np.ndarray) -> int:
    from zlib import crc32

    return crc32(np.ascontiguousarray(ids, dtype="<u4"))


def with_end(ids: Iterable[np.ndarray], end: int) -> Iterator[np.ndarray]:
    last = np.array([end], dtype="<u4")
    for x in ids:
        yield np.concatenate([x, last])
