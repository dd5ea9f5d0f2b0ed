import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from skyfold.llm import pieces, simple8b, token_files
from skyfold.session import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", " ", "Don't 'S I'LL we've", "a\x1cb \x1d c", "ΑΣ ὈΔΥΣΣΕΎΣ", "İstanbul I", "é ́x", "x\xa0y z\x85w", "<|endoftext|> <|STARTOFTEXT|>", "½²³ ª º µ ǆ ß", "“quoted” – dash… €5", "日本語 テスト 😀👍🏽", "a_b--c 12,345.67", "\x00\x07 tab\there", "Größe ÉÈ çà Ñandú", "x" * 3000, "'re'ver 're", "힣한국어"]


@pytest.fixture(scope="module")
def whole():
    return LIBRARY


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library(whole, text):
    assert np.frombuffer(pieces.coder(PATH).ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x250, exclude_categories=["Cs"]), st.sampled_from("'stdlrevm <|>ſΣİ́ €"))))
def test_ids_equal_the_library_on_any_text(text):
    assert np.frombuffer(pieces.coder(PATH).ids(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 50000), st.integers(0, 2**64 - 1)), max_size=400))
def test_simple8b_round_trip(values):
    array = np.array(values, np.uint64)
    words, escaped = simple8b.encode(array)
    assert simple8b.decode(words, escaped, len(values)).tolist() == values
    chunks, index = simple8b.pack(array, 64)
    assert simple8b.unpack(memoryview(b"".join(chunks)), index).tolist() == values


def test_simple8b_packs_small_values_densely():
    assert len(simple8b.encode(np.ones(600, np.uint64))[0]) == 10
    assert len(simple8b.encode(np.full(300, 1000, np.uint64))[0]) == 50
    words, escaped = simple8b.encode(np.array([1 << 60, 5, (1 << 64) - 1], np.uint64))
    assert len(escaped) == 2 and len(words) == 3


def written(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long, name string")
    folder = new_path(spark, "ids")
    manifest = token_files.write_ids(docs, folder, PATH, **options)
    return manifest, token_files.read_ids(spark, folder, manifest, with_ids=True)


def test_files_round_trip(spark, whole):
    rows = [(i * 7 % 101, " ".join(ODD[: i % len(ODD)]) if i % 5 else None, 1, "x") for i in range(101)]
    manifest, back = written(spark, rows, file_ids=200)
    got = {r.doc_id: r for r in back.collect()}
    start = 0
    for doc_id, text, _, _ in sorted(rows):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert manifest.count() > 3 and len(got) == 101


def test_edge_rows(spark):
    assert written(spark, [])[1].count() == 0
    back = written(spark, [(None, "one", 0, ""), (3, None, 0, ""), (3, "b", 0, ""), (3, "b", 0, ""), (-5, "", 0, "")])[1].orderBy("start").collect()
    assert [r.doc_id for r in back] == [None, -5, 3, 3, 3]
    assert [r.n_tokens for r in back] == [2, 1, 1, 2, 2] and [r.start for r in back] == [0, 2, 3, 4, 6]


def test_unlisted_files_are_ignored(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    folder = new_path(spark, "ids")
    manifest = token_files.write_ids(docs, folder, PATH)
    (token_files.write_file(folder, "part-999999-000000.s8b", token_files.file_chunks([(9, b"\1\0\0\0")])))
    assert [r.doc_id for r in token_files.read_ids(spark, folder, manifest).collect()] == [1]


def test_listed_files_must_be_there(spark, tmp_path):
    folder = tmp_path / "ids"
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(60)] + [(99, "long " * 200_000)], "doc_id long, text string")
    manifest = token_files.write_ids(docs, str(folder), public_tokenizers.path("word_bpe_49k.json"), file_ids=200)
    assert token_files.read_ids(spark, str(folder), manifest).count() == 61
    sorted(p for p in folder.iterdir() if p.name.endswith(token_files.SUFFIX))[0].unlink()
    with pytest.raises(Exception, match="missing file"):
        token_files.read_ids(spark, str(folder), manifest).collect()
