"""Byte-level BPE by a table of distinct words, and decoding through a table of pieces.

Texts are split into words in Spark. Each distinct word is encoded once and its ids are joined back into the places where it
occurs. The table has two parts. Its head are the commonest words of a bounded sample of the texts: at most ``head`` words of
at most ``WORD_BYTES`` bytes, so it is broadcast. All other words go the way of a shuffled table: each word with the texts
and places where it stands, packed by bucket of words, brought together, encoded once, and joined back to the text by position. No
text travels, and no word comes back: a text is an outline, the head's number of each word with 0 for the others, and the ids of these
come back by place. Which words are in the head changes the time and never the result.

A text and its words are brought together by a 64-bit hash of the text and told apart by place and a check of the word, so two
texts with one hash keep their own ids.

Defined cases: a null text is empty and has no ids; the strings of added tokens become their ids; repeated rows are all
returned; an empty table gives an empty result; ids without a piece are skipped in decoding, and bytes that are not UTF-8
become U+FFFD; further columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import whole_text
from claimweave.session import staged

WORD_BYTES = 256
SALTS = 32

# Words that are not in the head travel in packs, one per bucket of words and this many words of a task's texts.
BUCKETS = 1024
PACK_WORDS = 1 << 18

# Fixed value: the word pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Bytes of the check that tells words apart whose texts have one hash and that stand at one place.
CHECK_BYTES = 3

# Letters up to here are written out for a plain pattern, which is twice as fast and covers most Latin texts.
LATIN = 0x180


def latin_pattern() -> str:
    """``PATTERN`` for texts without characters from ``LATIN`` on."""
    kinds = {"L": "", "N": "", "S": " \t\n\x0b\x0c\r\x85\xa0"}
    for c in map(chr, range(LATIN)):
        kind = unicodedata.category(c)[0]
        if kind in "LN":
            kinds[kind] += c
    letters, numbers, space = kinds["L"], kinds["N"], kinds["S"]
    return (
        f" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


@functools.cache
def unassigned() -> str:
    """A pattern of the code points without a character, but for surrogates."""
    gaps, start = [], None
    for code in range(0x110001):
        empty = code < 0x110000 and unicodedata.category(chr(code)) == "Cn"
        if empty and start is None:
            start = code
        elif not empty and start is not None:
            gaps.append(f"{re.escape(chr(start))}-{re.escape(chr(code - 1))}")
            start = None
    return "[" + "".join(gaps) + "]"


@functools.lru_cache(maxsize=2)
def _splitter(added: tuple[tuple[str, int], ...]):
    """A function from a text to its words; added tokens are words of their own."""
    from tokenizers.pre_tokenizers import ByteLevel

    any_words, latin_words = regex.compile(PATTERN).findall, re.compile(latin_pattern()).findall
    beyond, unknown = re.compile(f"[^\x00-{chr(LATIN - 1)}]").search, re.compile(unassigned()).search
    library, letters = ByteLevel(add_prefix_space=False), byte_letters()

    def words(text: str) -> list[str]:
        if not beyond(text):
            return latin_words(text)
        if unknown(text):
            # Character tables of different years disagree on these: the library's own decides.
            return [bytes(letters[c] for c in word).decode() for word, _ in library.pre_tokenize_str(text)]
        return any_words(text)

    if not added:
        return words
    strings = sorted((a for a, _ in added), key=len, reverse=True)
    marks = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")")
    known = {a for a, _ in added}

    def split(text: str) -> list[str]:
        if not any(a in text for a in known):
            return words(text)
        out = []
        for piece in marks.split(text):
            out += [piece] if piece in known else words(piece)
        return out

    return split


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """A tokenizer file's content; loaded by path on the driver and sent to the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.content = file.read()
        spec = json.loads(self.content)
        kind = (spec.get("pre_tokenizer") or {}).get("type")
        if spec["model"]["type"] != "BPE" or kind != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path} is not a byte-level BPE without a normalizer")
        self.added = tuple(sorted((t["content"], t["id"]) for t in spec["added_tokens"]))
        letters = byte_letters()
        self.pieces = {
            i: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
            for token, i in spec["model"]["vocab"].items()
        } | {i: token.encode() for token, i in self.added}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that only few texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _encoder(content: str, added: tuple[tuple[str, int], ...]):
    """A function from words to their packed ids, for one task: kept workers need not hold the tables."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    known = dict(added)

    def encode(words: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch(words, add_special_tokens=False)
        return [packed([known[w]] if w in known else e.ids) for w, e in zip(words, found)]

    return encode


def _count(added):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(added)
        for batch in batches:
            counts: Counter = Counter()
            for part in _slices(batch):
                for text in part["text"].to_pylist():
                    counts.update(split(text))
            # What occurs once in a batch of texts is no candidate for the head. A word longer than the bound, in
            # characters, is longer in bytes too.
            kept = {w: n for w, n in counts.items() if n > 1 and len(w) <= WORD_BYTES}
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], ["word", "n"]
            )

    return count


def _encode_words(shared, added):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value, added)
        for batch in batches:
            ids = encode(batch["word"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], pa.array(ids, pa.binary())], ["word", "n", "ids"])

    return run


def head_words(texts: DataFrame, vocabulary: Vocabulary, shared, sample: int, head: int) -> dict[str, bytes]:
    """The commonest words of about ``sample`` texts with their ids, the commonest first.

    Words are taken by their counts' power of the eighth root of two, as many whole steps as fit, so that no ranking of
    all words is needed.
    """
    rows = texts.count()
    drawn = texts.where(F.pmod("h", F.lit(2**31)) < min(1.0, sample / max(rows, 1)) * 2.0**31)
    counts = staged(
        drawn.select("text")
        .mapInArrow(_count(vocabulary.added), "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.octet_length("word") <= WORD_BYTES)
        .withColumn("step", F.floor(F.log2("n") * 8).cast("int")),
        "word-counts",
    )
    least, room = None, head
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        if row["count"] > room:
            break
        least, room = row["step"], room - row["count"]
    if least is None:
        return {}
    chosen = counts.where(F.col("step") >= least).select("word", "n")
    table = chosen.mapInArrow(_encode_words(shared, vocabulary.added), "word string, n bigint, ids binary").toArrow()
    table = table.sort_by([("n", "descending"), ("word", "ascending")])
    return dict(zip(table["word"].to_pylist(), table["ids"].to_pylist()))


def check(word: str) -> bytes:
    return struct.pack("<I", zlib.crc32(word.encode()))[:CHECK_BYTES]


def varint(n: int) -> bytes:
    """A number below 2^63 in groups of seven bits, the lowest first."""
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        n |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return n, at


def entry_end(word: str, ids: bytes) -> bytes:
    """A word's check and its ids, with two bytes an id if they suffice."""
    numbers = memoryview(ids).cast("I")
    wide = max(numbers, default=0) > 0xFFFF
    kept = ids if wide else struct.pack(f"<{len(numbers)}H", *numbers)
    return b"".join([check(word), varint(2 * len(numbers) + wide), kept])


def entry(place: int, word: str, ids: bytes) -> bytes:
    """A word's place in its text, its check and its ids."""
    return varint(place) + entry_end(word, ids)


def read_entries(chunks: list[bytes]) -> dict[tuple[int, bytes], bytes]:
    """Packed ids by place and check."""
    found = {}
    for data in chunks:
        at = 0
        while at < len(data):
            place, at = _read_varint(data, at)
            mark = data[at : at + CHECK_BYTES]
            size, at = _read_varint(data, at + CHECK_BYTES)
            n, wide = divmod(size, 2)
            end = at + n * (4 if wide else 2)
            found[place, mark] = data[at:end] if wide else packed(struct.unpack(f"<{n}H", data[at:end]))
            at = end
    return found


def open_places(words: list[str], known: dict[str, int]) -> dict[str, int]:
    """The distinct words that the head lacks, numbered by first occurrence."""
    return {w: i for i, w in enumerate(dict.fromkeys([w for w in words if w not in known]))}


def outline(words: list[str], known: dict[str, int]) -> bytes:
    """The head's number of each word, 0 for others; then which of the others stand there, and their checks.

    Numbers go byte by byte: all lowest bytes, all middle ones, all highest ones. Another word is 0 where it is met first, or
    its distance from the next new one: both compress well.
    """
    numbers = [known.get(w, 0) for w in words]
    planes = np.array(numbers, "<u4").view("u1").reshape(-1, 4)[:, :3].T.tobytes()
    others = [w for w, n in zip(words, numbers) if not n]
    places: dict[str, int] = {}
    which = []
    for w in others:
        if w in places:
            which.append(len(places) - places[w])
        else:
            places[w] = len(places)
            which.append(0)
    return b"".join([struct.pack("<II", len(words), len(which)), planes, struct.pack(f"<{len(which)}I", *which), *map(check, places)])


def fill(data: bytes, chunks: list[bytes], ids: list[bytes]) -> bytes:
    """All ids of a text, from its outline, the entries of its other words and the ids of the head by number."""
    n, n_which = struct.unpack_from("<II", data)
    planes = np.zeros((n, 4), "u1")
    planes[:, :3] = np.frombuffer(data, "u1", 3 * n, 8).reshape(3, n).T
    numbers = planes.view("<u4").ravel().tolist()
    if not n_which:
        return b"".join([ids[i] for i in numbers])
    found, at = read_entries(chunks), 8 + 3 * n + 4 * n_which
    met: list[bytes] = []
    others = []
    for back in struct.unpack_from(f"<{n_which}I", data, 8 + 3 * n):
        if not back:
            met.append(found[len(met), data[at : at + CHECK_BYTES]])
            at += CHECK_BYTES
        others.append(met[-back or -1])
    rest = iter(others)
    return b"".join([ids[i] if i else next(rest) for i in numbers])


def _planes(numbers: list[int]) -> bytes:
    """Numbers below 2^32 byte by byte: all lowest bytes first, which compress well."""
    return np.array(numbers, "<u4").view("u1").reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes, n: int, at: int) -> list[int]:
    return np.ascontiguousarray(np.frombuffer(data, "u1", 4 * n, at).reshape(4, n).T).view("<u4").ravel().tolist()


def pack_words(runs: list[tuple[bytes, list[tuple[int, int]]]]) -> tuple[bytes, bytes]:
    """Words with the (hash of the text, place) pairs where each stands: the hashes, and the compressed rest."""
    words = [w for w, _ in runs]
    hits = [x for _, found in runs for x in found]
    rest = [
        struct.pack("<II", len(words), len(hits)),
        _planes([len(w) for w in words]),
        _planes([len(found) for _, found in runs]),
        _planes([place for _, place in hits]),
        *words,
    ]
    return struct.pack(f"<{len(hits)}q", *[h for h, _ in hits]), zstandard.ZstdCompressor(level=3).compress(b"".join(rest))


def unpack_words(hashes: bytes, pressed: bytes) -> list[tuple[str, list[tuple[int, int]]]]:
    data = zstandard.ZstdDecompressor().decompress(pressed)
    n_words, n = struct.unpack_from("<II", data)
    sizes, counts = _from_planes(data, n_words, 8), _from_planes(data, n_words, 8 + 4 * n_words)
    at = 8 + 8 * n_words
    hits = list(zip(struct.unpack(f"<{n}q", hashes), _from_planes(data, n, at)))
    at, first, runs = at + 4 * n, 0, []
    for size, count in zip(sizes, counts):
        runs.append((data[at : at + size].decode(), hits[first : first + count]))
        at, first = at + size, first + count
    return runs


def _tail_words(head, added, most: int = PACK_WORDS):
    """The words of a text that the head lacks with their places, once per text and batch, in packs by the word's bucket."""

    def packs(found: dict[str, list[tuple[int, int]]]) -> pa.RecordBatch:
        buckets: dict[int, list] = {}
        for text, data in sorted(found.items()):
            word = text.encode()
            code = zlib.crc32(word)
            if len(word) <= WORD_BYTES:
                buckets.setdefault(code % BUCKETS, []).append((word, data))
                continue
            # A word of the tail is rare or longer than the head allows; long ones could be common and are salted.
            salted: dict[int, list[tuple[int, int]]] = {}
            for x in data:
                salted.setdefault((code + x[0] % SALTS) % BUCKETS, []).append(x)
            for bucket, part in salted.items():
                buckets.setdefault(bucket, []).append((word, part))
        made = [pack_words(runs) for runs in buckets.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(buckets, pa.int32()), pa.array([x for x, _ in made], pa.binary()), pa.array([x for _, x in made], pa.binary())],
            ["bucket", "hashes", "words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = _splitter(added), head.value
        found: dict[str, list[tuple[int, int]]] = {}
        n = 0
        for batch in batches:
            met = set()
            for part in _slices(batch):
                for h, text in zip(part["h"].to_pylist(), part["text"].to_pylist()):
                    if (h, hash(text)) not in met:
                        met.add((h, hash(text)))
                        rest = open_places(split(text), known)
                        for word, place in rest.items():
                            found.setdefault(word, []).append((h, place))
                        n += len(rest)
                        if n >= most:
                            yield packs(found)
                            found, n = {}, 0
        if found:
            yield packs(found)

    return run


def _encode_packs(shared, added, most: int = PACK_WORDS):
    """Packs sorted by bucket: each distinct word of a bucket is encoded once, or once in ``most`` words of it.

    The entries of a text that are in one pack go on in one row: a pack's size is fixed, so their number follows from the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends, last = _encoder(shared.value, added), {}, None
        for batch in batches:
            for part in _slices(batch, 100):
                hashes, chunks = [], []
                for bucket, *pack in zip(*[part[n].to_pylist() for n in ("bucket", "hashes", "words")]):
                    if bucket != last or len(ends) > most:
                        ends, last = {}, bucket
                    runs = unpack_words(*pack)
                    fresh = [w for w, _ in runs if w not in ends]
                    ends |= {w: entry_end(w, ids) for w, ids in zip(fresh, encode(fresh))}
                    entries: dict[int, bytes] = {}
                    for word, hits in runs:
                        end = ends[word]
                        for h, place in hits:
                            entries[h] = entries.get(h, b"") + varint(place) + end
                    hashes += entries.keys()
                    chunks += entries.values()
                yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(chunks, pa.binary())], ["h", "chunk"])

    return run


def _outlines(head, added):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known, press = _splitter(added), head.value, zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            for part in _slices(batch):
                made = [press(outline(split(t), known)) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part[n] for n in names], pa.array(made, pa.binary())], [*names, "pressed"])

    return run


def _join_ids(head_ids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, ids = zstandard.ZstdDecompressor().decompress, head_ids.value
        for batch in batches:
            names = [n for n in batch.schema.names if n not in ("pressed", "tail")]
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = [fill(open_(x.as_py()), tail.as_py() or [], ids) for x, tail in zip(part["pressed"], part["tail"])]
                yield pa.RecordBatch.from_arrays([*[part[n] for n in names], pa.array(out, pa.binary())], [*names, "ids"])

    return run


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    key: str = "doc_id",
    text: str = "text",
    sample: int = 50_000,
    head: int = 400_000,
) -> DataFrame:
    """The key and ``ids`` of every row: little-endian unsigned 32-bit numbers in a binary."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary.content)
    body = whole_text(text)
    texts = docs.select(F.col(key).alias("k"), F.xxhash64(body).alias("h"), body.alias("text"))
    if head >= 1 << 24:
        raise ValueError("Word numbers have three bytes")
    common = head_words(texts, vocabulary, shared, sample, head)
    # Numbers count from 1: 0 stands for all other words.
    known = spark.sparkContext.broadcast({w: i for i, w in enumerate(common, 1)})
    head_ids = spark.sparkContext.broadcast([b"", *common.values()])
    tails = (
        texts.select("h", "text")
        .mapInArrow(_tail_words(known, vocabulary.added), "bucket int, hashes binary, words binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encode_packs(shared, vocabulary.added), "h bigint, chunk binary")
        # Dealt out first: lists of one chunk would be built and moved otherwise, as few chunks of a text meet in a task.
        .repartition("h")
        .groupBy("h")
        .agg(F.collect_list("chunk").alias("tail"))
    )
    kind = texts.schema["k"].dataType.simpleString()
    pressed = texts.mapInArrow(_outlines(known, vocabulary.added), f"k {kind}, h bigint, pressed binary")
    joined = pressed.join(tails, "h", "left").select("k", "pressed", "tail")
    return joined.mapInArrow(_join_ids(head_ids), f"k {kind}, ids binary").withColumnRenamed("k", key)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the texts of its ids, each id looked up in the broadcast table of pieces."""
    pieces = encoded.sparkSession.sparkContext.broadcast(vocabulary.pieces)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pieces.value
        for batch in batches:
            names = [n for n in batch.schema.names if n != text]
            for at in range(0, batch.num_rows, 500):
                part, out = batch.slice(at, 500), []
                for data in part[ids].to_pylist():
                    numbers = memoryview(data or b"").cast("I")
                    try:
                        raw = b"".join([piece[i] for i in numbers])
                    except KeyError:
                        raw = b"".join([piece.get(i, b"") for i in numbers])
                    out.append(raw.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*[part[n] for n in names], pa.array(out, pa.string())], [*names, text])

    return encoded.mapInArrow(run, ", ".join([*schema, f"`{text}` string"]))


def token_ids(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """``encoded`` with the ids as an array of long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != ids]
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                numbers = [memoryview(x or b"").cast("I").tolist() for x in part[ids].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part[n] for n in names], pa.array(numbers, pa.list_(pa.int64()))], [*names, ids]
                )

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != ids]
    return encoded.mapInArrow(run, ", ".join([*schema, f"`{ids}` array<bigint>"]))
