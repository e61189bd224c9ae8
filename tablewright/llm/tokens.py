"""Whole texts to token ids with a byte-level BPE of the ``tokenizers`` library, inside Arrow tasks.

A text is cut before every single space that stands between two characters that are not white space.
The tokenizer splits there too (a space joins the word after it), so a text's ids are the ids of its
segments in a row. Segments repeat a great deal; each worker keeps the ids of those it met, up to
``MAX_KEPT``, and calls the tokenizer for new ones only. Texts whose white space is irregular just give
longer segments. ``tests/llm/test_tokens.py`` compares with encoding whole texts.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from tablewright.llm.hashing import SPACE, release_memory, span_hashes

MAX_KEPT = 1_500_000
JOINED = 200
#: bytes of new segments that one call of the tokenizer takes; what it gives back is some hundred times the size of the ids
CALL_BYTES = 1 << 17
#: new segments of a call of ``encode`` from which the memory they took is given back at once
RELEASED = 10_000

# white space, and the lead bytes of wider characters that may be white space; 1C to 1F count for some libraries
MAYBE_SPACE = SPACE.copy()
MAYBE_SPACE[28:32] = True
MAYBE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True

_encoders: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str, end_id: int | None = 2) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    key = f"{path}\0{end_id}"
    if key not in _encoders:
        _encoders[key] = Encoder(path, end_id)
    return _encoders[key]


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches between cuts: before each single space between two characters that are not white space, and between texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(data == 32)
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    good = ~(MAYBE_SPACE[before] | MAYBE_SPACE[after])
    good &= ~((before >= 128) & (MAYBE_SPACE[data[np.maximum(at - 2, 0)]] | MAYBE_SPACE[data[np.maximum(at - 3, 0)]]))
    cut = np.zeros(len(data) + 1, bool)
    cut[at[good]] = True
    cut[bounds] = True
    starts = np.flatnonzero(cut[:-1])
    return starts, np.append(starts[1:], len(data))


class Encoder:
    """Ids of many texts at once. ``end_id``, where given, follows every text. Strings of special tokens in a text get their ids, as the library gives them."""

    def __init__(self, path: str, end_id: int | None = 2) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self._opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self._end_id = end_id
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._size = np.zeros(0, np.int64)
        self._ids = np.zeros(1 if self._end_id is None else 1, np.uint32)
        self._ids[0] = self._end_id or 0

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``data``, ``bounds``: as ``hashing.text_bytes`` gives them. All ids in a row, and the bounds of each text."""
        starts, ends = segments(data, bounds)
        rows = len(bounds) - 1
        first = np.searchsorted(starts, bounds)
        first[-1] = len(starts)
        keys = span_hashes(data, starts, ends, lower=False)
        distinct, sample, place = np.unique(keys, return_index=True, return_inverse=True)
        where = np.searchsorted(self._keys, distinct)
        known = where < len(self._keys)
        known[known] = self._keys[where[known]] == distinct[known]
        if not known.all():
            new = ~known
            self._learn(distinct[new], data, starts[sample[new]], ends[sample[new]])
            where = np.searchsorted(self._keys, distinct)
        at, size = self._at[where][place], self._size[where][place]
        if self._end_id is not None:
            # one more segment behind each text
            slot = np.arange(len(starts)) + np.repeat(np.arange(rows), np.diff(first))
            all_at, all_size = np.zeros(len(starts) + rows, np.int64), np.ones(len(starts) + rows, np.int64)
            all_at[slot], all_size[slot] = at, size
            at, size, first = all_at, all_size, first + np.arange(rows + 1)
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = self._ids[np.repeat(at - total[:-1], size) + np.arange(total[-1])]
        if len(self._keys) > MAX_KEPT:
            self._forget()
        return ids, total[first]

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        # plain segments (a space, then no white space) are joined: in their ids a space opens each one and nothing else
        spaces = np.zeros(len(data) + 1, np.int64)
        np.cumsum(MAYBE_SPACE[data], out=spaces[1:])
        plain = (data[starts] == 32) & (spaces[ends] - spaces[starts] == 1) & (ends - starts > 1)
        raw = data.tobytes()
        texts = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        joined = np.flatnonzero(plain)
        blocks = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        order: list[np.ndarray] = []
        alone = [np.flatnonzero(~plain)]
        for block, found in zip(blocks, self._call([b"".join([texts[i] for i in b]) for b in blocks]), strict=True):
            heads = np.flatnonzero(self._opens[found])
            if len(heads) == len(block) and heads[0] == 0:
                ids.append(found)
                sizes.append(np.diff(heads, append=len(found)))
                order.append(block)
            else:
                alone.append(block)
        rest = np.concatenate(alone)
        found_alone = self._call([texts[i] for i in rest])
        ids += found_alone
        sizes.append(np.fromiter(map(len, found_alone), np.int64, len(found_alone)))
        order.append(rest)
        size = np.concatenate(sizes)
        at = len(self._ids) + np.cumsum(size) - size
        # the new keys alone are sorted, then put between the known ones
        new = keys[np.concatenate(order)]
        rank = np.argsort(new)
        where = np.searchsorted(self._keys, new[rank]) + np.arange(len(rank))
        old = np.ones(len(self._keys) + len(rank), bool)
        old[where] = False
        for name, own in (("_keys", new), ("_at", at), ("_size", size)):
            have = getattr(self, name)
            merged = np.empty(len(old), have.dtype)
            merged[old], merged[where] = have, own[rank]
            setattr(self, name, merged)
        self._ids = np.concatenate([self._ids, *ids])
        if len(keys) > RELEASED:
            release_memory()

    def _call(self, texts: list[bytes]) -> list[np.ndarray]:
        sizes = np.cumsum([len(t) for t in texts])
        out: list[np.ndarray] = []
        while len(out) < len(texts):
            first = len(out)
            stop = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + CALL_BYTES, "right")))
            part = [t.decode("utf-8", "replace") for t in texts[first:stop]]
            lists = [f.ids for f in self._tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            ends = np.cumsum([len(ids) for ids in lists])
            flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(ends[-1]))
            out += [flat[end - len(ids) : end] for end, ids in zip(ends.tolist(), lists, strict=True)]
        return out
