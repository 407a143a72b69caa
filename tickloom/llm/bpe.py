"""Byte-level BPE encoding and decoding by merge replay.

The words of a slice of the corpus are laid out as one array of byte symbols. An inverted index maps
every mergeable pair, by the rank of its concatenation, to the positions where it stands. Ranks are
taken in rising order; each merge touches only its own position and the two neighbours, whose new
pairs join the index. A pair that arises with a lower rank than the one being replayed is replayed
first, so every word ends as the greedy encoder would leave it. Words are independent of each
other, so the slice is the unit that a task replays and nothing is shuffled: the index
of a slice, not of the corpus, is what has to fit in memory.

Most words come again, so a worker keeps a bounded table from words to ids, and only new words are
replayed. Very long texts are split in stretches, cut only at single spaces between two non-space
characters, where the pattern always ends a match.

NULL is the empty text: no ids. Repeated rows give repeated results, an empty table gives an empty
table, and columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import slices, texts

# A cut that no match crosses. Python's \s also has the separators U+001C to U+001F: fewer cuts, never wrong ones.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Longest stretch of text that is split at once. Known words, and characters of them, above which the table shrinks to its
# most frequent words, and how many those are.
_STRETCH = 1 << 20
_KNOWN, _KNOWN_CHARACTERS, _FREQUENT = 200_000, 1 << 23, 50_000
# Bytes of text that go through one replay.
_SLICE = 1 << 21
# Up to this many places of a pair, a loop is faster than array operations.
_FEW = 12


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeReplay:
    """Replays the merges of a rank table over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        # Every split of a token into two tokens is a pair that merges into it.
        pairs = sorted(
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        )
        self.keys, self.merged = np.array([*pairs, (1 << 62, -1)]).T.copy()
        self.merges = dict(pairs)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank that each pair merges into, -1 for none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of each. A word that is a token is that token."""
        sizes = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        symbol = self.single[raw]
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        split = np.repeat(whole < 0, sizes)  # symbols of words that need merges
        place = np.arange(raw.size)
        last = np.zeros(raw.size, bool)
        last[ends[sizes > 0] - 1] = True
        following = np.where(last, -1, place + 1)
        before = np.where(np.roll(last, 1), -1, place - 1)
        pair = np.full(raw.size, -1)  # rank of the pair that starts at a place
        open_ = np.flatnonzero(split & ~last)
        pair[open_] = self._ranks(symbol[open_], symbol[open_ + 1])
        self._merge(symbol, following, before, pair)
        symbol[~split] = -1
        first = (ends - sizes)[whole >= 0]
        symbol[first] = whole[whole >= 0]
        left = symbol >= 0
        counts = np.diff(np.cumsum(left)[ends - 1] * (ends > 0), prepend=0) if raw.size else np.zeros(sizes.size, np.int64)
        return symbol[left], counts

    def _merge(self, symbol: np.ndarray, following: np.ndarray, before: np.ndarray, pair: np.ndarray) -> None:
        """Apply every merge in place; a symbol that a merge swallowed becomes -1."""
        at = np.flatnonzero(pair >= 0)
        if not at.size:
            return
        at = at[np.argsort(pair[at], kind="stable")]
        starts = np.flatnonzero(np.diff(pair[at], prepend=-1))
        index = dict(zip(pair[at[starts]].tolist(), (x.tolist() for x in np.split(at, starts[1:]))))
        order = list(index)
        heapify(order)

        def note(rank: int, place: int) -> None:
            if rank in index:
                index[rank].append(place)
            else:
                index[rank] = [place]
                heappush(order, rank)

        views = [memoryview(x) for x in (symbol, following, before, pair)]
        while order:
            rank = heappop(order)
            places = index.pop(rank)
            if len(places) > _FEW:
                some = np.array(places)
                some = np.unique(some[pair[some] == rank])  # the others have changed since
                if some.size > _FEW and self._merge_at_once(rank, some, symbol, following, before, pair, note):
                    continue
                places = some.tolist()
            self._merge_in_turn(rank, sorted(set(places)), *views, note)

    def _merge_at_once(self, rank, places, symbol, following, before, pair, note) -> bool:
        """All places of a pair together; False, with nothing done, where their order matters."""
        second = following[places]
        after, left = following[second], before[places]
        right_of, left_of = after >= 0, left >= 0
        if (pair[second] == rank).any() or (pair[after[right_of]] == rank).any():
            return False  # places that touch
        new_right = self._ranks(np.full(right_of.sum(), rank), symbol[after[right_of]])
        new_left = self._ranks(symbol[left[left_of]], np.full(left_of.sum(), rank))
        new = np.concatenate([new_right, new_left])
        if ((new >= 0) & (new < rank)).any():
            return False
        symbol[places], symbol[second] = rank, -1
        following[places] = after
        before[after[right_of]] = places[right_of]
        pair[places] = pair[second] = -1
        where = np.concatenate([places[right_of], left[left_of]])
        pair[where] = new
        for r, p in zip(new[new >= 0].tolist(), where[new >= 0].tolist()):
            note(r, p)
        return True

    def _merge_in_turn(self, rank, places, symbol, following, before, pair, note) -> None:
        """From left to right; what remains goes back once a pair of lower rank has arisen."""
        merges = self.merges.get
        for n, at in enumerate(places, 1):
            if pair[at] != rank:
                continue  # an earlier merge took one side
            second = following[at]
            after, left = following[second], before[at]
            symbol[at], symbol[second] = rank, -1
            following[at], pair[at], pair[second] = after, -1, -1
            lower = False
            if after >= 0:
                before[after] = at
                if (new := merges(rank << 32 | symbol[after], -1)) >= 0:
                    pair[at] = new
                    note(new, at)
                    lower = new < rank
            if left >= 0:
                pair[left] = new = merges(symbol[left] << 32 | rank, -1)
                if new >= 0:
                    note(new, left)
                    lower |= new < rank
            if lower and n < len(places):
                for place in places[n:]:
                    note(rank, place)
                return


@lru_cache(maxsize=1)
def _unknown_to_reference() -> str:
    """Letters and digits here that the reference encoder's older Unicode tables leave unassigned.

    Matching must follow those tables, so these count as neither letter nor digit.
    """
    one_byte = {bytes([b]): b for b in range(256)}
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    there = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]+", mergeable_ranks=one_byte, special_tokens={})
    known = set(bytes(there.encode_ordinary(every)).decode())
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if c not in known)


class Matcher:
    """All matches of the splitting pattern, in the reference encoder's Unicode version."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.odd = frozenset(_unknown_to_reference())
        self.private_use = dict.fromkeys(map(ord, self.odd), "\ue000")

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self.odd.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.private_use))]


class _Codes(dict):
    """Numbers strings in order of arrival, and adds up their characters."""

    characters = 0

    def __missing__(self, key: str) -> int:
        self[key] = code = len(self)
        self.characters += len(key)
        return code


class Codec:
    """Encodes whole texts; one per Python worker and rank file."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.replay = MergeReplay(ranks)
        self.match = Matcher(pattern)
        bytes_of = {rank: token for token, rank in ranks.items()}
        self.vocabulary = [bytes_of.get(i) for i in range(max(bytes_of) + 1)]
        self._known([], np.empty(0, np.int32), np.empty(0, np.int64))

    def _known(self, words: Iterable[str], flat: np.ndarray, counts: np.ndarray) -> None:
        """Known words by code: where their ids start in ``flat``, how many they are, how often the word has come."""
        self.codes = _Codes()
        for word in words:
            self.codes[word]
        self.flat, self.counts, self.starts = flat, counts, np.cumsum(counts) - counts
        self.seen = np.zeros(counts.size, np.int64)

    def _shrink(self) -> None:
        """Only frequent words stay, and of those only short ones where words are long."""
        words = list(self.codes)
        often = np.sort(np.argsort(-self.seen, kind="stable")[:_FREQUENT])
        often = often[[len(words[i]) * _FREQUENT <= _KNOWN_CHARACTERS for i in often]]
        self._known([words[i] for i in often], self._ids(often), self.counts[often])

    def _learn(self) -> None:
        """One replay over the words that have a code but no ids yet."""
        words = [w.encode() for w in islice(self.codes, self.counts.size, None)]
        ids, counts = self.replay.encode(words)
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts])
        self.starts = np.cumsum(self.counts) - self.counts

    def encode(self, some: Iterable[str]) -> list[np.ndarray]:
        """Ids of every text. ``some`` should be a few megabytes at most."""
        if len(self.codes) > _KNOWN or self.codes.characters > _KNOWN_CHARACTERS:
            self._shrink()
        code = self.codes.__getitem__
        coded = []
        for text in some:
            found = [np.fromiter(map(code, self.match(stretch)), np.int32) for stretch in _stretches(text)]
            coded.append(found[0] if len(found) == 1 else np.concatenate(found))
        if len(self.codes) > self.counts.size:
            self._learn()
        self.seen = np.pad(self.seen, (0, self.counts.size - self.seen.size))
        self.seen += np.bincount(np.concatenate([*coded, np.empty(0, np.int32)]), minlength=self.counts.size)
        return [self._ids(codes) for codes in coded]

    def _ids(self, codes: np.ndarray) -> np.ndarray:
        counts = self.counts[codes]
        ends = np.cumsum(counts)
        shift = np.repeat(self.starts[codes] - (ends - counts), counts)
        return self.flat[shift + np.arange(shift.size)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


def _stretches(text: str) -> Iterator[str]:
    """The text in parts of about a megabyte, each but the first starting with its single space."""
    start = 0
    while len(text) - start > _STRETCH and (cut := _CUT.search(text, start + _STRETCH)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


IDS = "doc_id bigint, ids array<int>"
DECODED = f"{IDS}, decoded binary"


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    coder = codec(path, pattern)
    for part in chain.from_iterable(slices(b, "text", _SLICE) for b in batches):
        found = coder.encode(part.column("text").to_pylist())
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.empty(0, np.int32)])))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])


def _decode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    coder = codec(path, pattern)
    for batch in batches:
        ids = batch.column("ids")
        flat, ends = ids.flatten().to_numpy(), (ids.offsets.to_numpy() - ids.offsets[0].as_py()).tolist()
        decoded = [coder.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every whole text. ``path``: the rank file, at the same place on every executor."""
    return texts(docs).mapInArrow(partial(_encode_batches, path=path, pattern=pattern), IDS)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds the decoded bytes to (doc_id, ids); NULL ids are no ids."""
    ids = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return ids.mapInArrow(partial(_decode_batches, path=path, pattern=pattern), DECODED)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass through one Python worker."""

    def both(batches):
        return _decode_batches(_encode_batches(batches, path, pattern), path, pattern)

    return texts(docs).mapInArrow(both, DECODED)


def digests(coded: DataFrame, *more: str) -> DataFrame:
    """Counts and digests of ids and decoded bytes, one row per document, and columns of ``coded``."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
