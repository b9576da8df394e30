import zlib

import numpy as np
import pytest

from tidepool.llm import token_planes as tp


def reference_ids(tokenizer, texts, plain=False):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer)
    if plain:
        t.encode_special_tokens = True
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


TEXTS = ["", "   ", " a", "a  b\n\n c'the don't 's x²3 “q”   z aж! <|endoftext|> 3rd\t\tx", "''ll a", "é́a", "x\u00a0 y",
         "a\u2003 b", "\x00\x1f ", "I'm we've '", "日本語 text", "tab\tnew\r\nline  ", "..a..b 1a2 b3", "don't 'til"]


def test_pieces_equal_whole_texts(tokenizer, spark, sf_dir):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    for plain in (False, True):
        got = tp.PieceEncoder(tokenizer, plain).encode(texts)
        assert [list(map(int, g)) for g in got] == reference_ids(tokenizer, texts, plain)


def test_special_strings_as_the_library_reads_them(tokenizer):
    text = "a <|endoftext|> b"
    got = [tp.PieceEncoder(tokenizer, plain).encode([text])[0].tolist() for plain in (False, True)]
    assert got == [reference_ids(tokenizer, [text])[0], reference_ids(tokenizer, [text], True)[0]]
    assert 50256 in got[0] and len(got[0]) == 4 and len(got[1]) == 9


def test_renewed_table_of_pieces(tokenizer, monkeypatch):
    import random
    monkeypatch.setattr(tp, "CACHE_PIECES", 40)
    enc, rng = tp.PieceEncoder(tokenizer), random.Random(3)
    for _ in range(30):
        texts = ["".join(rng.choices("abcdE é.,' \n1", k=80)) for _ in range(2)]
        assert [g.tolist() for g in enc.encode(texts)] == reference_ids(tokenizer, texts)


@pytest.mark.parametrize("bits", [False, True])
def test_planes(bits):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
        assert (tp.from_planes(tp.to_planes(ids, bits), n) == ids).all()


@pytest.mark.parametrize("bits,block", [(False, 1 << 16), (True, 50)])
def test_files(spark, odd_docs, odd_rows, tokenizer, bits, block):
    path = tp.write_planes(odd_docs, tokenizer, bits=bits, block_ids=block)
    rows = tp.digests(tp.read_documents(spark, path)).collect()
    ids = [[*x, 2] for x in reference_ids(tokenizer, [t or "" for _, t, _ in odd_rows])]
    want = sorted(((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _, _), x in zip(odd_rows, ids)), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=str) == want
    rows.sort(key=lambda r: r.start)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    sizes = [r.n_ids for r in spark.read.parquet(f"{path}/blocks").collect()]
    assert max(sizes) <= block and sum(sizes) == sum(map(len, ids))


def test_empty(spark, no_docs, tokenizer):
    path = tp.write_planes(no_docs, tokenizer)
    assert tp.digests(tp.read_documents(spark, path)).count() == 0
