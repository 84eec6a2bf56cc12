"""Op 6: files read back equal the library's ids, grammars expand to their input, edge rows."""

import random
import zlib
from array import array

import numpy as np
from tokenizers import Tokenizer

from conftest import SF001
from pacewise.llm import queries, tokenfiles
from pacewise.session import fresh_dir


def want(docs):
    library, start, out = Tokenizer.from_file(queries.VOCABULARY), 0, []
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        ids = array("I", [*library.encode(t or "", add_special_tokens=False).ids, 1]).tobytes()
        out.append((d, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def run(spark, docs):
    path = fresh_dir(spark, "t-tokens")
    tokenfiles.write(spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, ids int").repartition(3), path, queries.VOCABULARY)
    return sorted((tuple(r) for r in tokenfiles.digests(spark.read.parquet(path)).collect()), key=lambda r: r[1])


def test_grammar_round_trip():
    rnd = random.Random(4)
    for n, most in [(1, 3), (50, 3), (4000, 9), (9000, 400), (3000, 1)]:
        docs = [array("I", [rnd.randrange(2, 2 + most) for _ in range(rnd.randrange(1, 1 + n // 9 + 1))] + [1]).tobytes() for _ in range(9)]
        block = tokenfiles.Block(tokenfiles.pack_block([*range(8), None], docs, 500))
        assert [d.tobytes() for d in block.documents()] == docs
        assert [block.document(k).tobytes() for k in range(9)] == docs
        assert all(block.lengths[k] == len(block.expand(np.array([500 + k]))) for k in range(len(block.lengths)))
    long = array("I", [5, 6, 7, 8] * 20_000 + [1]).tobytes()
    assert len(tokenfiles.pack_block([1], [long], 49408)) < len(long) / 8


def test_rows(spark, monkeypatch):
    docs = [(4, "b text"), (2, None), (9, ""), (2, "the first <|endoftext|> one"), (None, "no id"), (7, "“curly” 中文"), (7, "“curly” 中文")]
    docs += [(100 + k, "several words again and again " * (k % 7)) for k in range(60)] + [(50, "long " * 30_000)]
    assert run(spark, docs) == want(docs)
    monkeypatch.setattr(tokenfiles, "BLOCK_TOKENS", 40)
    assert run(spark, docs) == want(docs)
    assert run(spark, []) == []


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op6_tokenfiles(spark, SF001).collect()), key=lambda r: r[1]) == want(docs)
