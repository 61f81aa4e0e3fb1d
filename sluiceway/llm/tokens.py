"""Whole-text tokenization with a cache of chunks.

The `tokenizers` library does all the encoding; a text is only cut, before that, at places
where its pre-tokenizer always cuts, and equal chunks are encoded once. A text with a chunk
for which that can't be said is encoded whole. The cache holds 128 bits of hash for a chunk
instead of its string, about 50 bytes a chunk with all that is known of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sluiceway.llm.common import one_thread

one_thread()

from tokenizers import Tokenizer  # noqa: E402

#: Chunks kept by a worker; beyond that, those that were not seen again are forgotten.
CACHED_CHUNKS = 1_000_000
#: Bytes of a chunk from which its hash is a cryptographic one; the fast one is for short ones.
LONG_CHUNK = 128
#: Chunks encoded as one text, and such texts encoded at once.
JOINED = 100


def tokenizer_path(name: str) -> str:
    """Where this machine has the named public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Parts the chunks of a text while it is split; a text that has it is encoded whole.
CUT = "\0"


@dataclass(frozen=True)
class Kind:
    """How the chunks of a text follow from its pre-tokenizer.

    breaks: what is written for these characters before the text is split at CUT.
    mark: a character that is always one piece and one id; it parts chunks that are encoded together.
    fold: applied to texts once broken up; must not change any id.
    spaces: whether white space has ids (then a chunk of white space has borders of pieces only as `blank` says).
    """

    breaks: tuple[tuple[str, str], ...]
    mark: str
    fold: Callable
    spaces: bool


KINDS = {
    # Pieces are words, numbers or runs of signs, each with one space before it if there is one.
    "byte_level": Kind(((" ", f"{CUT} "), ("\n", f"{CUT}\n{CUT}"), (".", f"{CUT}."), (",", f"{CUT},")), "\n", lambda t: t, True),
    # Pieces are words, single digits or runs of signs; white space is dropped, case is folded.
    "spaceless": Kind(((" ", CUT), ("\n", CUT), (".", f"{CUT}."), (",", f"{CUT},")), "0", pc.ascii_lower, False),
}


#: What is known of a chunk: starts with a sign; ends in a letter or digit; starts with white space; has white space
#: where no border of pieces can be vouched for; is empty; is a line feed, to be judged by its neighbours.
SIGN, WORD, SPACED, BLANK, EMPTY, FEED = (1 << i for i in range(6))


class _Flags(dict):
    """Flags by a chunk's first two and last characters, which decide them (of a shorter chunk, all of it)."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = out = _flags(chunk)
        return out


def _flags(chunk: str) -> int:
    first, last = chunk[:1], chunk[-1:]
    out = SIGN * (first in (".", ",")) | WORD * last.isalnum() | SPACED * first.isspace() | EMPTY * (not chunk) | FEED * (chunk == "\n")
    blank = last.isspace() or first.isspace() and first != " " or chunk[:2].isspace()
    return out | BLANK * (blank and chunk != "\n")


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the odd base modulo 2**64, and of its inverse."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        rows = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, b, np.uint64)
            steps[:1] = 1
            rows.append(np.multiply.accumulate(steps))
        _POWERS[base] = rows[0], rows[1]
    return _POWERS[base]


def chunk_hashes(chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each string."""
    offsets = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
    data = np.frombuffer(chunks.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    values, out = data.astype(np.uint64) + np.uint64(1), []
    for base, odd in ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xD6E8FEB86659FD93, 0x94D049BB133111EB)):
        power, inverse = _powers(base, len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * power[: len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
        h = (h ^ h >> np.uint64(32)) * np.uint64(odd)
        out.append(h ^ h >> np.uint64(29))
    for i in np.flatnonzero(ends - starts > LONG_CHUNK).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        out[0][i], out[1][i] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
    return out[0], out[1]


class ChunkedTokenizer:
    """encode(texts) -> (ids of all texts, ids in each text).

    special_as_text: whether a special token's string in a text is ordinary text; by default it
    is that token, as the library has it, and a text that contains one is encoded whole.
    """

    def __init__(self, file: str, kind: Kind, cached: int = CACHED_CHUNKS, special_as_text: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = special_as_text
        self.specials = () if special_as_text else tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.kind, self.cached = kind, cached
        (self.mark_id,) = self.tokenizer.encode(kind.mark, add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        # sorted first hashes with the places of their chunks; by place: second hash, ids in `flat`, flags, whether seen again
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.second, self.start, self.length, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.flags, self.again = np.zeros(0, np.uint8), np.zeros(0, bool)

    def _sweep(self) -> None:
        """Forgets the chunks that were not seen again since the last sweep, and of the others all but the latest half of the limit."""
        kept = np.flatnonzero(self.again)[-(self.cached // 2) :] if self.cached > 1 else np.zeros(0, np.int64)
        new = np.full(len(self.second), -1, np.int32)
        new[kept] = np.arange(len(kept), dtype=np.int32)
        held = new[self.place] >= 0
        self.keys, self.place = self.keys[held], new[self.place[held]]
        self.flat = gather(self.flat, self.start[kept], self.length[kept])
        self.second, self.length, self.flags = self.second[kept], self.length[kept], self.flags[kept]
        self.start = (np.cumsum(self.length) - self.length).astype(np.int32)
        self.again = np.zeros(len(kept), bool)

    def _ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the chunks, where those of each start, and their numbers. Chunks without the mark are joined by it, JOINED at a time."""
        mark = self.kind.mark
        plain = [i for i, c in enumerate(chunks) if mark not in c and c]
        every = mark.join(chunks)
        for special in self.specials:
            if special in every:
                plain = [i for i in plain if special not in chunks[i]]
        texts = [mark.join([chunks[i] for i in plain[k : k + JOINED]]) for k in range(0, len(plain), JOINED)]
        found: list[np.ndarray] = [np.zeros(0, np.uint32)]
        for k in range(0, len(texts), JOINED):
            for e in self.tokenizer.encode_batch_fast(texts[k : k + JOINED], add_special_tokens=False):
                found.append(np.array([*e.ids, self.mark_id], np.uint32))
        ids = np.concatenate(found)
        marks = np.flatnonzero(ids == self.mark_id)
        if len(marks) != len(plain):
            plain, ids, marks = [], ids[:0], marks[:0]
        lengths = np.zeros(len(chunks), np.int64)
        lengths[plain] = np.diff(marks, prepend=-1) - 1
        ids = ids[ids != self.mark_id]
        starts = np.cumsum(lengths) - lengths
        known = set(plain)
        single = [i for i, c in enumerate(chunks) if c and i not in known] if len(plain) < len(chunks) else []
        if single:
            each = [e.ids for e in self.tokenizer.encode_batch_fast([chunks[i] for i in single], add_special_tokens=False)]
            lengths[single] = own = np.fromiter(map(len, each), np.int64, len(each))
            starts[single] = len(ids) + np.cumsum(own) - own
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(each), np.uint32, int(own.sum()))])
        return ids, starts, lengths

    def _places(self, chunks: pa.LargeStringArray) -> np.ndarray:
        """Where what is known of each of the distinct chunks is."""
        if len(self.second) > self.cached:  # not before the block that needed them was done
            self._sweep()
        first, second = chunk_hashes(chunks)
        at = np.searchsorted(self.keys, first)
        near = np.minimum(at, max(len(self.keys) - 1, 0))
        if len(self.keys):
            places = np.where(self.keys[near] == first, self.place[near], -1)
            places[self.second[places] != second] = -1
        else:
            places = np.full(len(first), -1, np.int32)
        self.again[places[places >= 0]] = True
        new = np.flatnonzero(places < 0)
        if len(new):
            strings = chunks.take(pa.array(new)).to_pylist()
            ids, starts, lengths = self._ids(strings)
            known = _Flags()
            flags = np.fromiter((known[c if len(c) < 3 else c[:2] + c[-1]] for c in strings), np.uint8, len(strings))
            n = len(self.second)
            places[new] = np.arange(n, n + len(new), dtype=np.int32)
            self.start, self.length = np.append(self.start, (starts + len(self.flat)).astype(np.int32)), np.append(self.length, lengths.astype(np.int32))
            self.flat, self.second = np.append(self.flat, ids), np.append(self.second, second[new])
            self.flags, self.again = np.append(self.flags, flags), np.append(self.again, np.zeros(len(new), bool))
            order = new[np.argsort(first[new], kind="stable")]
            self.keys, self.place = np.insert(self.keys, at[order], first[order]), np.insert(self.place, at[order], places[order])
        return places

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _unsure(self, flags: np.ndarray, codes: np.ndarray, borders: np.ndarray, texts: pa.Array) -> set[int]:
        """Numbers of the texts in which a chunk's border may not be a border of pieces, or that have a special token.

        flags: of the distinct chunks; codes: which of these each chunk is; texts: after `fold`.
        """
        first = np.zeros(len(codes) + 1, bool)
        first[borders] = True
        bad = []
        some = np.bitwise_or.reduce(flags) if len(flags) else 0
        if some & SIGN:
            signs = np.flatnonzero((flags & SIGN > 0)[codes])
            signs = signs[~first[signs]]  # so each has a chunk before it in its text
            bad.append(signs[flags[codes[signs - 1]] & WORD == 0])
        if self.kind.spaces:
            if some & BLANK:
                bad.append(np.flatnonzero((flags & BLANK > 0)[codes]))
            if some & EMPTY:  # fine as a text of its own only
                at = np.flatnonzero((flags & EMPTY > 0)[codes])
                bad.append(at[~(first[at] & first[at + 1])])
            if some & FEED:  # stands between two characters that aren't white space
                at = np.flatnonzero((flags & FEED > 0)[codes])
                border = first[at] | first[at + 1]
                bad += [at[border], at[~border][flags[codes[at[~border] + 1]] & SPACED > 0]]
        found = np.concatenate(bad) if bad else np.zeros(0, np.int64)
        unsure = set((np.searchsorted(borders, found, "right") - 1).tolist()) if len(found) else set()
        return unsure.union(*(np.flatnonzero(pc.match_substring(texts, s).to_numpy(zero_copy_only=False)).tolist() for s in self.specials))

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts_cut = np.flatnonzero(pc.match_substring(texts, CUT).to_numpy(zero_copy_only=False)).tolist()
        cut = texts
        for sign, written in self.kind.breaks:
            cut = pc.replace_substring(cut, sign, written)
        cut = self.kind.fold(cut)  # not before: Arrow's ascii_lower is wrong for a slice
        parts = pc.split_pattern(cut, CUT)
        borders = parts.offsets.to_numpy().astype(np.int64)
        borders -= borders[0]
        coded = parts.flatten().dictionary_encode()
        del parts
        known, codes = self._places(coded.dictionary), coded.indices.to_numpy()
        starts, lengths = self.start[known][codes], self.length[known][codes]
        unsure = self._unsure(self.flags[known], codes, borders, cut).union(texts_cut)
        del cut
        if unsure:
            arrays = [self.whole(texts[i].as_py()) if i in unsure else gather(self.flat, starts[a:b], lengths[a:b]) for i, (a, b) in enumerate(zip(borders.tolist(), borders[1:].tolist(), strict=False))]
            return np.concatenate(arrays), np.fromiter(map(len, arrays), np.int64, len(arrays))
        return gather(self.flat, starts, lengths), np.diff(np.append(0, np.cumsum(lengths, dtype=np.int64))[borders])


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[0] : starts[0] + lengths[0]], then that of 1, and so on, as one array."""
    total = int(lengths.sum(dtype=np.int64))
    if not total:
        return flat[:0]
    kind = np.int32 if max(total, len(flat)) < 2**31 else np.int64
    steps = (starts - (np.cumsum(lengths, dtype=kind) - lengths)).astype(kind)
    where = np.repeat(steps, lengths)
    where += np.arange(total, dtype=kind)
    return flat[where]


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end` after those of each text."""
    after = lengths + 1
    out = np.full(len(ids) + len(lengths), end, np.uint32)
    held = np.ones(len(out), bool)
    held[np.cumsum(after) - 1] = False
    out[held] = ids
    return out, after


_READY: dict[tuple[str, str, bool], ChunkedTokenizer] = {}


def worker_tokenizer(file: str, kind: str, cached: int = CACHED_CHUNKS, special_as_text: bool = False) -> ChunkedTokenizer:
    """This worker's tokenizer, kept with its cache for later tasks. kind: byte_level or spaceless."""
    key = file, kind, special_as_text
    if key not in _READY:
        _READY[key] = ChunkedTokenizer(file, KINDS[kind], cached, special_as_text)
    return _READY[key]
