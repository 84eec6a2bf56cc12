"""Op 1 against the tokenizer library, and edge rows."""

import hashlib
import random
from array import array

import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from pacewise.llm import bpe, queries
from conftest import SF001

ODD = "aabcdeé ñ'st ll re'Σςİ \x1c\x85 12²½ß—“中文한글😀́é\n\t.,;!#"


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(queries.VOCABULARY)))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.VOCABULARY)


def ids(library, text):
    return array("I", library.encode(text, add_special_tokens=False).ids).tobytes()


def test_random_texts_equal_the_library(coder, library):
    rnd = random.Random(1)
    for k in range(2500):
        alphabet = ODD if k % 2 else "aaabeinrsthoglz"
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        s = s[:9] + "<|endoftext|>" + s[9:] if k % 7 == 0 else s
        want = ids(library, s)
        assert coder.encode(s) == want, s
        assert coder.decode(want).decode() == library.decode(array("I", want).tolist(), skip_special_tokens=False)


def test_long_runs_without_a_space(coder, library):
    for s in ("a" * 5000, "ab" * 3000 + "9" * 50, "!" * 4001, "thing" * 900):
        assert coder.encode(s) == ids(library, s)


def test_caches_do_not_change_results(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 3)
    monkeypatch.setattr(bpe, "PREFIX_CACHE", 5)
    monkeypatch.setattr(bpe, "PAIR_CACHE", 5)
    text = "then the others gathered another feather " * 3
    small = bpe.Encoder(coder.v)
    for n in range(len(text)):
        assert small.encode(text[:n]) == ids(library, text[:n])


def test_compatibility_is_what_merging_does(coder, library):
    """A pair is compatible iff the library leaves the joined text as exactly these two tokens."""
    v, rnd = coder.v, random.Random(2)
    inner = [t for t, s in v._by_id.items() if all(97 <= ord(c) <= 122 for c in s)]
    final = [t for t, s in v._by_id.items() if all(97 <= ord(c) <= 122 for c in s[:-1]) and 353 <= ord(s[-1]) <= 378]
    for _ in range(1500):
        a, b = rnd.choice(inner), rnd.choice(final)
        word = v._by_id[a] + v._by_id[b][:-1] + chr(ord(v._by_id[b][-1]) - 256)
        got = library.encode(word, add_special_tokens=False).ids
        assert v.compatible(a, b) == (got == [a, b]), word


def test_rows(spark, library):
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("IDS", T.LongType()),
                           T.StructField("Decoded", T.LongType()), T.StructField("doc_id", T.LongType())])
    rows = [(None, 1, 1, 1), ("", 2, 2, 2), ("Some  words\n", 3, 3, None), ("Some  words\n", 3, 3, None)]
    out = bpe.encode_decode(spark.createDataFrame(rows, schema), queries.VOCABULARY)
    assert out.columns == ["text", "doc_id", "ids", "decoded"]
    got = sorted((r["text"] or "", bytes(r["ids"]), r["decoded"]) for r in out.collect())
    assert got[:2] == [("", b"", "")] * 2
    assert got[2] == got[3] == ("Some  words\n", ids(library, "some words"), "some</w> words</w>")
    back = bpe.decode(out.select("ids"), queries.VOCABULARY).collect()
    assert sorted(r["decoded"] for r in back) == ["", "", "some</w> words</w>", "some</w> words</w>"]
    empty = bpe.encode(spark.createDataFrame([], schema), queries.VOCABULARY)
    assert empty.collect() == []


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = queries.op1_bpe(spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        want = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(want, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(want), hashlib.sha256(array("I", want).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
