"""Byte-level BPE in column expressions: ranked merges folded over the bytes of distinct words.

A text is split by the vocabulary's pattern. A word's bytes become token numbers, and ``aggregate`` merges
the pair of lowest rank, leftmost first, until no pair has one. The rank map is a literal: two arrays in
which each pair of tokens has one possible place each (cuckoo hashing), so a look-up is two array reads.

Every distinct word of the corpus is folded once. A task lists the words of its part of the texts that are
no tokens themselves; they meet by word, are folded, and go back to a small dictionary for each part, in a
file of the shared folder. A second pass over the texts reads its part's dictionary and writes the ids.
Texts are never shuffled, nothing that grows with the data is broadcast, and a dictionary is no larger than
its part's words. Should a plan deal the rows out anew in the second pass, words that a dictionary lacks are
merged on the spot by a heap, to the same ids. So are words of more than ``LONG_WORD`` bytes (runs without
blank, digit or sign changes), since folding takes steps in proportion to the square of a word's length.

Decoding maps ids to their byte pieces and concatenates these.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from ..sources.session import new_path
from .common import giving_back, kept, parts, pieces
from .token_files import Memo, cut

LONG_WORD = 256

#: Bytes of text that a task handles at a time, one document at least, and words per batch of a word list.
PIECE, WORDS = 1 << 20, 1 << 16
#: Units that a task remembers (a cache only).
UNITS = 1 << 19
_P1, _P2 = 262_139, 196_613
#: A pair of tokens as one number: left times this plus right; no rank is as large.
_SIDE = 50_333
_RANK_BITS = 17
def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: token in base64 and rank per line. Read by the driver; executors need no such file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pairs_of(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(left * _SIDE + right, rank of both together) of all pairs of tokens that make a token."""
    if max(ranks.values()) >= _SIDE:
        raise ValueError(f"ranks must be below {_SIDE}")
    keys, found = [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                keys.append(left * _SIDE + right)
                found.append(rank)
    return np.array(keys, np.int64), np.array(found, np.int64)


def cuckoo(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two arrays; each key stands at ``key % P1`` of the first or at ``key % P2`` of the second."""
    tables = (np.full(_P1, -1, np.int64), np.full(_P2, -1, np.int64))
    for entry in (keys << _RANK_BITS | values).tolist():
        side = 0
        for _ in range(500):
            table, size = tables[side], (_P1, _P2)[side]
            at = (entry >> _RANK_BITS) % size
            entry, table[at] = int(table[at]), entry
            if entry < 0:
                break
            side = 1 - side
        else:
            raise ValueError("too many pairs for the tables")
    return tables


def _set_table(spark: SparkSession, name: str, kind: str, frame: DataFrame) -> None:
    """Make the single value of ``frame`` a session variable, which plans hold as a literal."""
    frame.createOrReplaceTempView("_bpe_value")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
    spark.sql(f"SET VAR {name} = (SELECT * FROM _bpe_value)")
    spark.catalog.dropTempView("_bpe_value")


def _array(spark: SparkSession, values: np.ndarray) -> DataFrame:
    frame = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(values)), "v": values}))
    return frame.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]))


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


#: In place of a rank: the pair makes no token.
_NO_RANK = 1 << 40


def _rank(left: str, right: str) -> str:
    def at(table: str, size: int) -> str:
        return f"{table}[cast(k % {size} AS INT)]"

    first, second = at("bpe_first", _P1), at("bpe_second", _P2)
    return _let("k", f"{left} * {_SIDE} + {right}", (
        f"CASE WHEN shiftright({first}, {_RANK_BITS}) = k THEN {first} & {(1 << _RANK_BITS) - 1} "
        f"WHEN shiftright({second}, {_RANK_BITS}) = k THEN {second} & {(1 << _RANK_BITS) - 1} ELSE {_NO_RANK}L END"
    ))


def fold(word: str) -> str:
    """SQL of a word's ids: bytes, then one merge per step while a pair has a rank.

    The state holds the tokens and the rank of each with its successor, of which a merge changes two.
    """
    start = f"transform(split(decode(cast({word} AS BINARY), 'ISO-8859-1'), ''), c -> bpe_bytes[ascii(c)])"
    tokens = "filter(transform(s.a, (x, i) -> CASE WHEN i = p THEN m WHEN i = p + 1 THEN NULL ELSE x END), x -> x IS NOT NULL)"
    ranks = (
        f"filter(transform(s.r, (x, i) -> CASE WHEN i = p - 1 THEN {_rank('get(s.a, p - 1)', 'm')} "
        f"WHEN i = p THEN {_rank('m', 'get(s.a, p + 2)')} WHEN i = p + 1 THEN NULL ELSE x END), x -> x IS NOT NULL)"
    )
    merged = _let("p", "cast(array_position(s.r, m) AS INT) - 1", f"named_struct('a', {tokens}, 'r', {ranks})")
    step = _let("m", "array_min(s.r)", f"IF(m >= {_NO_RANK}L, s, {merged})")
    first = f"named_struct('a', a, 'r', transform(a, (x, i) -> {_rank('x', 'get(a, i + 1)')}))"
    return _let("a", start, f"IF(size(a) < 2, a, aggregate(sequence(2, size(a)), {first}, (s, n) -> {step}, s -> s.a))")


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap over linked pieces, for words of any length."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(word[i:end[j]])
            if rank is not None:
                heap.append((rank, i, end[j])) if building else heapq.heappush(heap, (rank, i, end[j]))

    building = True
    for i in range(n - 1):
        offer(i)
    heapq.heapify(heap)
    building = False
    while heap:
        _, i, to = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != to:
            continue
        j = end[i]
        alive[j] = False
        end[i] = to
        if to < n:
            before[to] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def prepare(spark: SparkSession, ranks: dict[bytes, int]) -> None:
    """Set the literal tables of the session: ranks of pairs, tokens of single bytes, pieces of tokens."""
    keys, values = pairs_of(ranks)
    for name, table in zip(("bpe_first", "bpe_second"), cuckoo(keys, values)):
        _set_table(spark, name, "ARRAY<BIGINT>", _array(spark, table))
    _set_table(spark, "bpe_bytes", "ARRAY<BIGINT>", _array(spark, np.array([ranks[bytes([b])] for b in range(256)], np.int64)))
    frame = spark.createDataFrame(pd.DataFrame({"i": range(max(ranks.values()) + 1), "v": pieces_of(ranks)}), "i long, v binary")
    _set_table(spark, "bpe_pieces", "ARRAY<BINARY>", frame.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]),
    ))


def pieces_of(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    found = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        found[rank] = token
    return found


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


class _Vocabulary:
    """What a worker keeps of a vocabulary: how to split, and the ids (as bytes) of words that are tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.split = regex.compile(pattern).findall
        self.tokens = {t.decode(): np.array([r], "<i4").tobytes() for t, r in ranks.items() if _is_text(t)}
        self.ranks, self.pieces = ranks, np.array(pieces_of(ranks), object)
        self.decimals = np.array([str(i).encode() for i in range(len(self.pieces))], object)

    @classmethod
    def of(cls, name: str, ranks: dict[bytes, int], pattern: str) -> _Vocabulary:
        return kept(f"bpe {name}", lambda: cls(ranks, pattern))

    def matches(self, units: list[str]) -> set[str]:
        """What the pattern finds in units that follow single blanks (given without them)."""
        # One blank and letters are one match. The others in one text, which is cut nowhere but between them.
        found = {" " + u for u in units if u.isalpha()}
        found.update(self.split("".join([" " + u for u in units if not u.isalpha()])))
        return found

    def digests(self, ids: bytes) -> tuple[str, str]:
        """sha256 of the ids as decimal text and of the bytes that they decode to."""
        at = np.frombuffer(ids, "<i4")
        contents = b" ".join(self.decimals[at].tolist()), b"".join(self.pieces[at].tolist())
        return tuple(hashlib.sha256(x).hexdigest() for x in contents)


class _Encoder:
    """Whole texts to ids, unit by unit (see ``token_files.cut``); ``known`` has the ids of words.

    New words are added to what is known, so a task holds no more than its texts' words; of units it remembers
    ``UNITS`` at most.
    """

    def __init__(self, vocabulary: _Vocabulary, known: dict[str, bytes]):
        self.vocabulary, self.known = vocabulary, known
        self.units = Memo(self._unit, UNITS)
        self.after_blank = Memo(self._after_blank, UNITS)

    def _word(self, word: str) -> bytes:
        if word not in self.known:
            self.known[word] = np.array(merge_long(word.encode(), self.vocabulary.ranks), "<i4").tobytes()
        return self.known[word]

    def _unit(self, unit: str) -> bytes:
        return self.known.get(unit) or b"".join(map(self._word, self.vocabulary.split(unit)))

    def _after_blank(self, rest: str) -> bytes:
        # Letters and what is neither letter, digit nor white space are one match each.
        letters = rest.rstrip(punctuation)
        if letters != rest and letters.isalpha():
            return self._word(" " + letters) + self._word(rest[len(letters):])
        return self._unit(" " + rest)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian integers."""
        first, rest, end = cut(text or "")
        return b"".join((*map(self.units.__getitem__, first), *map(self.after_blank.__getitem__, rest), *map(self.units.__getitem__, end)))


def _name(ranks: dict[bytes, int], pattern: str) -> str:
    return hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()


def dictionaries(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> str:
    """Fold every distinct word of the texts once; the folder of each part's dictionary (``part=n``: w, ids).

    A word's row lists the parts that have it, of which there are as many as tasks that read the texts.
    """
    spark, name = documents.sparkSession, _name(ranks, pattern)
    prepare(spark, ranks)

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, plain, after_blank = _Vocabulary.of(name, ranks, pattern), set(), set()
        for piece in pieces(batches, "text", PIECE):
            for text in piece.column(0).to_pylist():
                first, rest, end = cut(text or "")
                plain.update(first, end)
                after_blank.update(rest)
        found = set().union(*map(vocabulary.split, plain))
        plain.clear()
        units = list(after_blank)
        after_blank.clear()
        while units:
            found.update(vocabulary.matches(units[-WORDS:]))
            del units[-WORDS:]
        new = [w for w in found.difference(vocabulary.tokens) if len(w.encode()) <= LONG_WORD]
        found.clear()
        part = TaskContext.get().partitionId()
        for at in range(0, len(new), WORDS):
            some = new[at:at + WORDS]
            yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(some), pa.int32()), "w": pa.array(some, pa.string())})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal words stand together; one row for each, with the parts that have it."""
        held, held_parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            w, part = batch.column(1), batch.column(0).to_numpy()
            starts = [0, *(np.flatnonzero(pa.compute.not_equal(w[1:], w[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist()]
            if held is not None:
                if w[0].as_py() == held:
                    part, starts = np.concatenate([held_parts, part]), [0, *(s + len(held_parts) for s in starts[1:])]
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([held], pa.string()), pa.array([held_parts], pa.list_(pa.int32()))], ["w", "all"])
            # The last word may go on in the next batch.
            ends, first = starts[1:], len(part) - len(w)
            lists = pa.ListArray.from_arrays(pa.array([0, *ends] if ends else [0], pa.int32()), pa.array(part, pa.int32()))
            if ends:
                yield pa.RecordBatch.from_arrays([w.take(pa.array([max(s - first, 0) for s in starts[:-1]])), lists], ["w", "all"])
            held, held_parts = w[-1].as_py(), part[starts[-1]:]
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.string()), pa.array([held_parts], pa.list_(pa.int32()))], ["w", "all"])

    words = documents.select("text").mapInArrow(giving_back(list_words), "part int, w string").repartition("w").sortWithinPartitions("w")
    words = words.mapInArrow(giving_back(gather), "w string, all array<int>")
    folded = words.select("w", F.expr(f"cast({fold('w')} AS ARRAY<INT>)").alias("ids"), "all")
    folder = new_path(spark, "bpe-words")
    rows = folded.select(F.explode("all").alias("part"), "w", "ids")
    rows.repartition(parts(spark), "part").write.partitionBy("part").parquet(folder)
    return folder


def _dictionary(folder: str, part: int) -> dict[str, bytes]:
    """The words of one part with their ids as bytes."""
    system, root = fs.FileSystem.from_uri(folder)
    found: dict[str, bytes] = {}
    for info in system.get_file_info(fs.FileSelector(f"{root}/part={part}", allow_not_found=True)):
        if info.is_file and info.base_name.endswith(".parquet") and info.base_name[0] not in "._":
            with system.open_input_file(info.path) as f:
                # Not read_table: that would look for partition columns in the path.
                table = pq.ParquetFile(f).read(["w", "ids"]).combine_chunks()
            ids = table["ids"].combine_chunks()
            raw = ids.flatten().to_numpy().astype("<i4").tobytes()
            ends = np.cumsum(pa.compute.list_value_length(ids).to_numpy()).tolist()
            found.update(zip(table["w"].to_pylist(), (raw[4 * a:4 * b] for a, b in zip([0, *ends], ends))))
    return found


def _encoded(documents: DataFrame, ranks: dict[bytes, int], pattern: str, finish, schema: StructType | str) -> DataFrame:
    """``finish(vocabulary, batch, ids of each text as bytes)`` of all rows, by each part's dictionary."""
    folder, name, at = dictionaries(documents, ranks, pattern), _name(ranks, pattern), documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary.of(name, ranks, pattern)
        encoder = _Encoder(vocabulary, vocabulary.tokens | _dictionary(folder, TaskContext.get().partitionId()))
        for piece in pieces(batches, "text", PIECE):
            yield finish(vocabulary, piece, list(map(encoder.encode, piece.column(at).to_pylist())))

    return documents.mapInArrow(giving_back(run), schema)


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``documents`` with a column ``ids`` (array of int): the tokens of ``text``.

    A null or empty text has no tokens. Every row is kept, repeated ones too, with all its columns; one
    named ``ids`` is replaced. No special tokens.
    """
    rows = documents.drop("ids")

    def with_ids(_, piece: pa.RecordBatch, ids: list[bytes]) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, ids)]) // 4
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
        return pa.RecordBatch.from_arrays([*piece.columns, lists], [*piece.schema.names, "ids"])

    return _encoded(rows, ranks, pattern, with_ids, StructType(list(rows.schema.fields)).add("ids", ArrayType(IntegerType())))


def decode(ids: str = "ids") -> Column:
    """The bytes of a column of ids, by the pieces of the last ``prepare``.

    Pieces may cut a character in two; as strings they are joined byte by byte all the same.
    """
    return F.expr(f"cast(array_join(transform({ids}, i -> cast(bpe_pieces[i] AS STRING)), '') AS BINARY)")


def round_trip(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the decoded bytes."""
    def digest(vocabulary: _Vocabulary, piece: pa.RecordBatch, ids: list[bytes]) -> pa.RecordBatch:
        digests = [vocabulary.digests(x) for x in ids]
        return pa.RecordBatch.from_pydict({
            "doc_id": piece.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids_sha256": pa.array([a for a, _ in digests], pa.string()), "decoded_sha256": pa.array([b for _, b in digests], pa.string()),
        })

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return _encoded(rows, ranks, pattern, digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
