"""Token ids as binary files: frequency-ranked ids in byte-aligned variable-length code.

A file holds whole documents in ascending doc_id order. Its ids are replaced by their rank of frequency
within the file (most frequent: 0, ties to the smaller id), so that most ids take one byte. Ranks are
written in one to four bytes; the byte counts stand apart, four to a control byte, two bits each. To
decode, a table lists the four lengths and their sum for every control byte, and numpy gathers all
values of a file by these lengths at once.

A file carries its own rank table, so it can be read without any other, and no pass over the corpus
precedes the writing. Layout (little-endian): ``MAGIC``, counts of documents, ids and ranks (uint32 each,
after the magic), rank table (uint32), doc_ids (int64) with a validity byte each, lengths (uint32),
control bytes, data bytes.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize, new_path
from . import files
from .common import kept, parts, pieces

MAGIC = b"RWLIDS1\n"
#: Ids of a file at most, but for the last document of it: what a task holds in memory while it writes.
IDS_PER_FILE = 8_000_000
#: Distinct units that a worker remembers, and a quarter as many rarer kinds. Only a cache: others are encoded anew.
CACHE_WORDS = 1_200_000

_BEFORE_BLANK = re.compile(r"(?<=\S)(?= \S)")
#: White space other than the blank; none is above.
_OTHER_SPACE = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")

_lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
#: Four lengths for each control byte.
LENGTHS = _lengths.astype(np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    width = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = width - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    ends = np.cumsum(width, dtype=np.int64)
    data = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    starts = ends - width
    data[starts] = ranks.astype(np.uint8)
    for k in (1, 2, 3):
        longer = np.flatnonzero(width > k)
        if not len(longer):
            break
        data[starts[longer] + k] = (ranks[longer] >> np.uint32(8 * k)).astype(np.uint8)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values again: lengths by table lookup, then one gather per byte position."""
    width = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = np.zeros(count, np.int64)
    np.cumsum(width[:-1], out=starts[1:])
    raw = np.frombuffer(data, np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(width > k)
        if not len(longer):
            break
        values[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def to_bytes(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A file's content."""
    counts = np.bincount(ids)
    kinds = np.flatnonzero(counts)
    order = np.lexsort((kinds, -counts[kinds]))
    rank = np.zeros(len(counts), np.uint32)
    rank[kinds[order]] = np.arange(len(kinds), dtype=np.uint32)
    control, data = pack(rank[ids])
    head = np.array([len(doc_ids), len(ids), len(kinds)], "<u4")
    valid = np.array([x is not None for x in doc_ids], np.uint8)
    keys = np.array([0 if x is None else x for x in doc_ids], "<i8")
    return b"".join((
        MAGIC, head.tobytes(), kinds[order].astype("<u4").tobytes(), keys.tobytes(), valid.tobytes(),
        np.asarray(lengths, "<u4").tobytes(), control, data,
    ))


def from_bytes(content: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a file's content."""
    if content[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    documents, count, kinds = (int(x) for x in np.frombuffer(content, "<u4", 3, 8))
    at = 20

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(content, kind, n, at)
        at += found.nbytes
        return found

    ranks, keys, valid, lengths = take("<u4", kinds), take("<i8", documents), take("u1", documents), take("<u4", documents)
    control = take("u1", -(-count // 4)).tobytes()
    ids = ranks[unpack(control, content[at:], count)] if count else np.zeros(0, np.uint32)
    return [int(k) if v else None for k, v in zip(keys, valid)], lengths, ids


def _blank_run(text: str) -> bool:
    """Whether white space follows a blank, or stands before a last one.

    Looking for each character is many times as fast as a pattern.
    """
    if "  " in text or text[-1:] == " " and text[-2:-1].isspace():
        return True
    return any(c in text and " " + c in text for c in _OTHER_SPACE)


def units(text: str) -> list[str]:
    """The text cut before single blanks between other characters, where no token can cross.

    The vocabulary's pattern joins one blank to what follows it, so encoding the units one by one gives
    the tokens of the whole text. Around longer runs of white space there is no cut.
    """
    if _blank_run(text):
        return _BEFORE_BLANK.split(text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + x for x in rest if x] + ([" "] if rest and not rest[-1] else [])


def cut(text: str) -> tuple[list[str], list[str], list[str]]:
    """The units in order: first ones, ones that follow a single blank (without it), and a last blank.

    Writing the blank of every unit again would take as long as the cutting.
    """
    if _blank_run(text):
        return units(text), [], []
    first, *rest = text.split(" ")
    # Without runs of blanks only the first and the last piece can be empty; a last one is a blank of its own.
    end = [" "] if rest and not rest[-1] else []
    if end:
        rest.pop()
    return [first] if first else [], rest, end


def byte_letters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: itself where printable, else one above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Memo(dict):
    """What ``make`` gives for a key, made when a key is first asked for; beyond ``most`` keys all are forgotten."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        # Made first: it may ask for other keys.
        found = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Whole texts to ids by the tokenizers library, as its own call gives them.

    A worker encodes distinct units once: one that is new to it is split by the vocabulary's pattern, and its
    words go through the library's BPE model. A text that holds one of the vocabulary's added tokens (marks
    that the library cuts out before all else) is encoded by the library as a whole.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(pattern).findall
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        #: Ids of the pattern's matches, of units, and of units by what follows their leading blank.
        self.words = Memo(self._word, CACHE_WORDS // 4)
        self.units = Memo(self._unit, CACHE_WORDS // 4)
        self.after_blank = Memo(self._after_blank, CACHE_WORDS)

    @classmethod
    def of(cls, path: str, pattern: str) -> Encoder:
        """The worker's encoder, kept between tasks."""
        return kept(f"encoder {path}", lambda: cls(path, pattern))

    def _word(self, word: str) -> bytes:
        """Ids of a match of the pattern."""
        # Of the visible ASCII characters every byte is written as itself.
        plain = word[0] == " " and word.isascii() and word[1:].isalnum()
        return array("I", [t.id for t in self.model.tokenize("\u0120" + word[1:] if plain else word.encode().decode("latin-1").translate(self.letters))]).tobytes()

    def _unit(self, unit: str) -> bytes:
        found = self.split(unit)
        if len(found) == 1:
            return self._word(unit)
        # One blank and letters are one match, and a unit as well.
        first = found[0][1:] if found and found[0][0] == " " else ""
        if first.isalpha():
            return self.after_blank[first] + b"".join(map(self.words.__getitem__, found[1:]))
        return b"".join(map(self.words.__getitem__, found))

    def _after_blank(self, rest: str) -> bytes:
        if rest.isalpha():
            return self._word(" " + rest)
        # Neither letters, digits nor white space: one match as well.
        letters = rest.rstrip(punctuation)
        if letters.isalpha():
            return self.after_blank[letters] + self.words[rest[len(letters):]]
        return self._unit(" " + rest)

    def _text(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, rest, end = cut(text)
        return b"".join((*map(self.units.__getitem__, first), *map(self.after_blank.__getitem__, rest), *map(self.units.__getitem__, end)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [self._text(x) for x in texts]


def write(documents: DataFrame, folder: str, tokenizer: str, pattern: str, end_id: int | None = 0) -> DataFrame:
    """Encode ``text`` and write files below ``folder`` in ascending doc_id order (nulls first).

    Returns the manifest, one row per file: path, part, number (order within the part), documents, ids.
    A null text is empty; rows with the same doc_id are ordered by a hash of their text; equal rows are
    all kept. An empty table has no files. Only doc_id and text are read, so further columns do not matter.
    The documents are shuffled once, by ranges of doc_id.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    n = parts(documents.sparkSession)
    ordered = rows.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = Encoder.of(tokenizer, pattern), TaskContext.get().partitionId(), 0
        keys, held, count = [], [], 0
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

        def flush() -> pa.RecordBatch:
            nonlocal keys, held, count, number
            lengths = np.array([len(x) // 4 for x in held], np.int64)
            content = to_bytes(keys, lengths, np.frombuffer(b"".join(held), "<u4"))
            path, stream = files.open_new(folder, ".ids")
            with stream:
                stream.write(content)
            row = pa.RecordBatch.from_pydict({
                "path": [path], "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                "documents": pa.array([len(keys)], pa.int64()), "ids": pa.array([int(lengths.sum())], pa.int64()),
            })
            keys, held, count, number = [], [], 0, number + 1
            return row

        for piece in pieces(batches, "text", 1 << 20):
            for key, found in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1).to_pylist())):
                keys.append(key)
                held.append(found + end)
                count += len(held[-1]) // 4
                if count >= IDS_PER_FILE:
                    yield flush()
        if keys:
            yield flush()

    manifest = ordered.mapInArrow(save, "path string, part int, number int, documents long, ids long")
    return materialize(manifest, "token-files")


def read(manifest: DataFrame) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids (binary).

    The starts come from sums per part, of which there are as many as tasks that wrote, and running
    sums within a part. One file is in memory at a time.
    """
    spark = manifest.sparkSession
    sums = sorted((r["part"], r["n"]) for r in manifest.groupBy("part").agg(F.sum("ids").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sums])]).astype(int).tolist()
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sums, before)], "part int, part_start long")
    placed = (
        manifest.join(F.broadcast(offsets), "part")
        .selectExpr(
            "path",
            "part_start + coalesce(sum(ids) OVER (PARTITION BY part ORDER BY number ROWS BETWEEN "
            "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS file_start",
        )
        .repartition(parts(spark))
    )

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_old(path) as f:
                    keys, lengths, ids = from_bytes(f.read())
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                raw = ids.astype("<u4").tobytes()
                for at in range(0, len(keys), 1000):
                    to = min(at + 1000, len(keys))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(keys[at:to], pa.int64()), "start": pa.array(starts[at:to] + start, pa.int64()),
                        "n_tokens": pa.array(lengths[at:to].astype(np.int64)),
                        "ids": pa.array([raw[4 * s:4 * e] for s, e in zip(starts[at:to].tolist(), ends[at:to].tolist())], pa.binary()),
                    })

    return placed.mapInArrow(load, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(documents: DataFrame, tokenizer: str, pattern: str, end_id: int | None = 0) -> DataFrame:
    """Write the files, read them back, and digest what they hold."""
    manifest = write(documents, new_path(documents.sparkSession, "ids"), tokenizer, pattern, end_id)
    return read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def digest_of(ids: list[int]) -> int:
    """The digest of one document, for tests."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
