"""Byte-level BPE by replaying the merges over many words at once, and decoding by the table of pieces.

A task takes its texts in slices and splits them into words. The distinct words that it has not met lie one after the other in
one sequence of symbols with links to both neighbours. An inverted index leads from every pair of symbols, by its rank, to the
places of the pair. Merges are applied in the order of ranks, each to all its places from left to right: a place whose pair
is no longer there is passed over, and a merge looks up only the two new pairs that it makes with its neighbours. Then every
text is the sequence of its words' ids.

Words are never moved between tasks, so texts are not either: nothing is shuffled, and a lost executor costs its own slices.
A task keeps the ids of words it has met, up to KNOWN of them, so common words are merged once a task.

A vocabulary made by merging has no pair that ranks before the merge that made it. For rank files where that does happen, the
word is encoded again on its own, pair by pair, which is exact for any ranks.

Defined cases: a null text is empty and has no ids; a word that is a piece itself is that piece; repeated rows are all
returned; very long texts are worked in parts and words of any length whole; an empty table gives an empty result; in
decoding, null ids are none and ids without a piece give no bytes; further columns are not read.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import whole_text
from claimweave.llm.bpe import LATIN, PATTERN, latin_pattern

# Characters of text in a slice, bytes of new words in one replay, and words that a task keeps.
SLICE = 1 << 21
REPLAY = 1 << 20
KNOWN = 400_000


class Ranks:
    """Pieces by id from a file of ranks, loaded on the driver and sent to the tasks."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ids = {base64.b64decode(piece): int(rank) for piece, rank in lines}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")


class Replay:
    """Encodes lists of words by the merges of a rank table."""

    def __init__(self, ids: dict[bytes, int]):
        self.ids = ids
        self.pieces = {i: piece for piece, i in ids.items()}
        self.size = max(self.pieces) + 1
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        self.ranks: dict[int, int] = {}

    def rank(self, left: int, right: int) -> int:
        """The id of two neighbours' joint piece, -1 if there is none."""
        pair = left * self.size + right
        found = self.ranks.get(pair)
        if found is None:
            found = self.ranks[pair] = self.ids.get(self.pieces[left] + self.pieces[right], -1)
        return found

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as packed 32-bit numbers."""
        out = [b""] * len(words)
        at, held, size = [], [], 0
        for i, word in enumerate(words):
            own = self.ids.get(word)
            if own is not None:
                out[i] = own.to_bytes(4, "little")
            elif word:
                at.append(i)
                held.append(word)
                size += len(word)
            if size >= REPLAY or i == len(words) - 1:
                for place, found in zip(at, self._replay(held)):
                    out[place] = found
                at, held, size = [], [], 0
        return out

    def _index(self, symbols: np.ndarray, ends: np.ndarray) -> dict[int, array]:
        """Places of all pairs by the pair's rank."""
        inside = np.ones(len(symbols), bool)
        inside[ends - 1] = False
        places = np.flatnonzero(inside)
        pairs = symbols[places].astype(np.int64) * self.size + symbols[places + 1]
        order = np.argsort(pairs, kind="stable")
        edges = np.flatnonzero(np.diff(pairs[order], prepend=-1))
        index: dict[int, array] = {}
        for a, b in zip(edges, [*edges[1:], len(order)]):
            left, right = divmod(int(pairs[order[a]]), self.size)
            rank = self.rank(left, right)
            if rank >= 0:
                index.setdefault(rank, array("i")).frombytes(places[order[a:b]].astype(np.int32).tobytes())
        return index

    def _replay(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        first = self.single[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, len(first) + 1, dtype=np.int32)
        before = np.arange(-1, len(first) - 1, dtype=np.int32)
        after[ends - 1] = before[starts] = -1
        symbols, after, before = (array("i", x.tobytes()) for x in (first, after, before))
        index, odd = self._index(first, ends), []
        queue, rank_of = list(index), self.rank
        heapq.heapify(queue)
        while queue:
            rank = heapq.heappop(queue)
            for place in sorted(index.pop(rank)):
                left, next_ = symbols[place], after[place]
                # Gone, last of its word by now, or part of another pair.
                if left < 0 or next_ < 0 or rank_of(left, symbols[next_]) != rank:
                    continue
                symbols[place], symbols[next_] = rank, -1
                beyond = after[place] = after[next_]
                made = []
                if beyond >= 0:
                    before[beyond] = place
                    made.append((rank_of(rank, symbols[beyond]), place))
                ahead = before[place]
                if ahead >= 0:
                    made.append((rank_of(symbols[ahead], rank), ahead))
                for new, where in made:
                    if new < 0:
                        continue
                    if new < rank:
                        odd.append(place)
                    if new in index:
                        index[new].append(where)
                    else:
                        index[new] = array("i", (where,))
                        heapq.heappush(queue, new)
        found = np.frombuffer(symbols, np.int32)
        live = found >= 0
        bounds = 4 * np.concatenate([[0], np.cumsum(np.add.reduceat(live, starts, dtype=np.int64))])
        packed = found[live].tobytes()
        out = [packed[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        for word in np.unique(np.searchsorted(ends, odd, side="right")):
            out[word] = self.alone(words[word])
        if len(self.ranks) > 5 * KNOWN:
            self.ranks.clear()
        return out

    def alone(self, word: bytes) -> bytes:
        """One word, the leftmost pair of the lowest rank at a time."""
        symbols: list[int | None] = self.single[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(word)), -1], [*range(-1, len(word) - 1)]

        def pair(place: int) -> int:
            next_ = after[place]
            return -1 if symbols[place] is None or next_ < 0 else self.rank(symbols[place], symbols[next_])

        queue = [(rank, i) for i in range(len(word)) if (rank := pair(i)) >= 0]
        heapq.heapify(queue)
        while queue:
            rank, place = heapq.heappop(queue)
            if pair(place) != rank:
                continue
            next_ = after[place]
            symbols[place], symbols[next_], after[place] = rank, None, after[next_]
            if after[next_] >= 0:
                before[after[next_]] = place
            for near in (place, before[place]):
                if near >= 0 and (new := pair(near)) >= 0:
                    heapq.heappush(queue, (new, near))
        return np.array([s for s in symbols if s is not None], np.int32).tobytes()


@functools.cache
def stand_ins() -> dict[int, str]:
    """Characters that the library's tables class otherwise than this pattern module's, with one of the class they have there."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    theirs, ours = {}, {}
    for kind, example in (("L", "x"), ("N", "1")):
        table = tiktoken.Encoding(kind, pat_str=rf"\p{{{kind}}}", mergeable_ranks=single, special_tokens={})
        theirs.update(dict.fromkeys(bytes(table.encode_ordinary(every)).decode(), example))
        ours.update(dict.fromkeys(regex.findall(rf"\p{{{kind}}}", every), example))
    return {ord(c): theirs.get(c, "!") for c in theirs.keys() | ours.keys() if theirs.get(c) != ours.get(c)}


def splitter(pattern: str, stands: dict[int, str]) -> Callable[[str], Iterator[list[str]]]:
    """A function from a text to lists of its words; the lists of a text in its order are the whole text."""
    compiled, latin = regex.compile(pattern), re.compile(latin_pattern())
    beyond = re.compile(f"[^\x00-{chr(LATIN - 1)}]").search
    other = re.compile("[" + "".join(map(re.escape, map(chr, sorted(stands)))) + "]").search if stands else lambda text: None
    plain = pattern == PATTERN

    def split(text: str) -> Iterator[list[str]]:
        latin_text = plain and not beyond(text)
        shadow = text.translate(stands) if not latin_text and other(text) else None
        if shadow is None and len(text) <= 2 * SLICE:
            yield latin.findall(text) if latin_text else compiled.findall(text)
            return
        found = (latin if latin_text else compiled).finditer(text if shadow is None else shadow)
        while spans := [m.span() for m in islice(found, SLICE // 4)]:
            yield [text[a:b] for a, b in spans]

    return split


def _encode(shared, pattern: str, stands: dict[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, split, known = Replay(shared.value), splitter(pattern, stands), {}

        def packed(words: list[str]) -> bytes:
            return b"".join(map(known.__getitem__, words))

        def learn(texts: list[list[str]]) -> None:
            if len(known) > KNOWN:
                known.clear()
            met = set().union(*texts)
            fresh = [w for w in met if w not in known]
            known.update(zip(fresh, replay.encode([w.encode() for w in fresh])))

        def column(parts: list[bytes]) -> pa.Array:
            ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))

        for batch in batches:
            parts: list[bytes] = []
            held: list[list[str]] = []
            size = start = 0

            def flush(end: int) -> pa.RecordBatch:
                learn(held)
                parts.extend(map(packed, held))
                return pa.RecordBatch.from_arrays([batch["k"].slice(start, end - start), column(parts)], ["k", "ids"])

            for i in range(batch.num_rows):
                text = batch["text"][i].as_py()
                if len(text) > 2 * SLICE:
                    if held:
                        yield flush(i)
                    own = []
                    for words in split(text):
                        learn([words])
                        own.append(packed(words))
                    held, parts, start, size = [], [b"".join(own)], i, 0
                    yield flush(i + 1)
                    parts, start = [], i + 1
                    continue
                held.append([word for words in split(text) for word in words])
                size += len(text)
                if size >= SLICE:
                    yield flush(i + 1)
                    held, parts, start, size = [], [], i + 1, 0
            if held:
                yield flush(batch.num_rows)

    return run


def encode(docs: DataFrame, ranks: Ranks, key: str = "doc_id", text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """The key and ``ids`` of every row; special tokens' strings are ordinary text."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks.ids)
    rows = docs.select(F.col(key).alias("k"), whole_text(text).alias("text"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(_encode(shared, pattern, stand_ins()), f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode(encoded: DataFrame, ranks: Ranks, ids: str = "ids", data: str = "data") -> DataFrame:
    """``encoded`` with the bytes of its ids as ``data``."""
    shared = encoded.sparkSession.sparkContext.broadcast({i: piece for piece, i in ranks.ids.items()})
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != data]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            names = [n for n in batch.schema.names if n != data]
            for at in range(0, batch.num_rows, 500):
                part, out = batch.slice(at, 500), []
                for row in part[ids]:
                    numbers = row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else ()
                    try:
                        out.append(b"".join([pieces[i] for i in numbers]))
                    except KeyError:
                        out.append(b"".join([pieces.get(i, b"") for i in numbers]))
                yield pa.RecordBatch.from_arrays([*[part[n] for n in names], pa.array(out, pa.binary())], [*names, data])

    return encoded.mapInArrow(run, ", ".join([*schema, f"`{data}` binary"]))
