"""Token files and byte-level BPE against the libraries."""

import hashlib
import re
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowloom.llm import bpe, token_files
from rowloom.sources.session import materialize, new_path

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(JSON)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1))))
def test_packing_round_trip(values):
    ranks = np.array(values, np.uint32)
    assert token_files.unpack(*token_files.pack(ranks), len(ranks)).tolist() == values


@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-2**63, 2**63 - 1)), st.lists(st.integers(0, 70_000)))))
def test_file_round_trip(documents):
    ids = np.array([i for _, d in documents for i in d], np.uint32)
    content = token_files.to_bytes([k for k, _ in documents], np.array([len(d) for _, d in documents]), ids)
    keys, lengths, back = token_files.from_bytes(content)
    assert keys == [k for k, _ in documents] and lengths.tolist() == [len(d) for _, d in documents] and back.tolist() == ids.tolist()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab'st \n\t 　é1.!\x1c", max_size=40))
def test_units_do_not_cut_tokens(text):
    encoder = token_files.Encoder.of(JSON, public_tokenizers.PATTERN)
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == whole
    assert "".join(token_files.units(text)) == text


def test_added_tokens_are_the_librarys(reference):
    encoder = token_files.Encoder.of(JSON, public_tokenizers.PATTERN)
    for text in ("a <|endoftext|> as text", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext|", "a <|endoftext |>"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == reference(text)
    assert reference("a <|endoftext|> as text") == [64, 220, 50256, 355, 2420]


def test_a_full_cache_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 3)
    encoder = token_files.Encoder(JSON, public_tokenizers.PATTERN)
    for text in [t or "" for t in brute.texts(10)] * 2:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == reference(text)


def test_letters_and_punctuation_need_no_pattern(reference):
    encoder = token_files.Encoder(JSON, public_tokenizers.PATTERN)
    encoder.split = None
    for text in (" word word, word. \u00e9t\u00e9!?", " x-- y.) \u4e2d\u6587, dogs' it'"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == reference(text)


def test_blank_runs_are_those_of_the_pattern():
    pattern = re.compile(r" \s|\s \Z")
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000)]):
        for text in (f"a {c}b", f"a{c} b", f"a{c} ", f" {c}", f"{c} a", f"a{c}"):
            assert token_files._blank_run(text) == bool(pattern.search(text))
    assert not token_files._blank_run("") and not token_files._blank_run(" ")


def test_files_hold_all_documents_in_order(spark, reference):
    rows = brute.rows()
    df = spark.createDataFrame(rows, brute.DDL).repartition(5)
    manifest = token_files.write(df, new_path(spark, "ids"), JSON, public_tokenizers.PATTERN)
    got = token_files.read(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens, ids[-1]) == (at, len(ids), 0)
        assert any(k == r.doc_id and reference(t) == ids[:-1] for k, t, *_ in rows)
        at += len(ids)
    assert manifest.agg(F.sum("ids")).first()[0] == at


def test_files_of_nothing(spark):
    df = spark.createDataFrame([], brute.DDL)
    assert token_files.round_trip(df, JSON, public_tokenizers.PATTERN).collect() == []


def test_token_digests(spark, reference):
    df = spark.createDataFrame([(2, "b c"), (1, None)], "doc_id long, text string")
    got = token_files.round_trip(df, JSON, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    two = [*reference("b c"), 0]
    assert [tuple(r) for r in got] == [
        (1, 0, 1, zlib.crc32(np.array([0], "<u4").tobytes())), (2, 1, len(two), zlib.crc32(np.array(two, "<u4").tobytes())),
    ]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


def test_bpe_equals_library(spark, ranks, monkeypatch):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = brute.rows(25)
    for spread in (True, False):
        df = spark.createDataFrame(rows, brute.DDL).withColumn("ids", F.lit("clash")).repartition(4)
        if not spread:  # parts that do not stay the same: the dictionaries are of no use
            monkeypatch.setattr(bpe, "_dictionary", lambda folder, part: {})
        got = bpe.encode(df, ranks, public_tokenizers.PATTERN).withColumn("back", bpe.decode("ids"))
        assert set(got.columns) == {*df.columns, "back"}
        got = got.select("doc_id", "text", "ids", "back").collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.back) == (r.text or "").encode()
    digest = bpe.round_trip(df.filter("doc_id = 5"), ranks, public_tokenizers.PATTERN).first()
    ids = library.encode_ordinary(dict((r[0], r[1]) for r in rows)[5])
    assert digest.n_tokens == len(ids) and digest.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), ranks, public_tokenizers.PATTERN).collect() == []


def test_bpe_folds_every_distinct_word_once(spark, ranks, monkeypatch):
    rows = [r for r in brute.rows(25) if not r[1] or max(map(len, r[1].split(" "))) < bpe.LONG_WORD]
    df = materialize(spark.createDataFrame(rows, brute.DDL).repartition(4))
    monkeypatch.setattr(bpe, "merge_long", None)  # all ids come from the folded words
    got = bpe.round_trip(df, ranks, public_tokenizers.PATTERN).collect()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert brute.ordered(got) == brute.ordered(want)


def test_known_letters_and_punctuation_need_no_pattern(ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    vocabulary = bpe._Vocabulary(ranks, public_tokenizers.PATTERN)
    vocabulary.split = None
    known = {w: np.array(library.encode_ordinary(w), "<i4").tobytes() for w in (" word", ",", ".\")", " qxz", "'")}
    for text in (" word, qxz.\") word", " word' qxz,"):
        assert np.frombuffer(bpe._Encoder(vocabulary, dict(known)).encode(text), "<i4").tolist() == library.encode_ordinary(text)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abcdeth ing!é", min_size=1, max_size=60))
def test_long_merges_equal_library(ranks, text):
    library = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    assert bpe.merge_long(text.encode(), ranks) == library.encode_ordinary(text)
