"""Encoding, BPE, packing and shards against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiflow.llm import bpe, packing, shards
from lexiflow.llm.queries import tokenizer_path
from lexiflow.llm.tokens import TextEncoder
from lexiflow.session import shared_dir

from .conftest import edge_texts

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def odd_texts():
    r = random.Random(5)
    letters = "ab  \n\t'sé日😀<|endoftext|>1 2.,!?\x85\xa0\u3000\u0301\x1c\x02ΣIİ"
    return ["", "   ", "aaaaaaaaaaaaaaa", "he's we'll  I'VE", " <|endoftext|><|endoftext|>\n\n x", "x\x02 \x02 y <|startoftext|>"] + [
        "".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(600)]


@pytest.mark.parametrize("path,kind", [(BYTE, "byte"), (WORD, "word")])
def test_encoder_equals_library(path, kind):
    library, texts = Tokenizer.from_file(path), odd_texts()
    got = TextEncoder(path, kind).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pair_index_equals_library():
    library, coder, texts = Tokenizer.from_file(BYTE), bpe.PairIndexBpe(BYTE), odd_texts()
    ids = [np.frombuffer(b, "<u4") for b in coder.encode(texts)]
    assert [i.tolist() for i in ids] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [coder.decode(i) for i in ids] == [library.decode(i.tolist(), skip_special_tokens=False) for i in ids]
    some = np.array([198, 0, 50256, 127, 222, 102], dtype="<u4")  # not UTF-8 as a whole
    assert coder.decode(some) == library.decode(some.tolist(), skip_special_tokens=False)


def test_encode_decode_edges(edge, empty):
    library = Tokenizer.from_file(BYTE)
    got = sorted(map(tuple, bpe.encode_decode(edge, BYTE).collect()), key=repr)
    want = sorted(((k, library.encode(t or "", add_special_tokens=False).ids, t or "") for k, t in edge_texts()), key=repr)
    assert got == want
    assert bpe.encode_decode(empty, BYTE).count() == 0


def test_choice_is_least_sum_of_squares():
    r, p = random.Random(2), packing.LevelPacker(16)
    for i in range(500):
        size = r.randint(1, 15)
        level, best = p.choose(size), None
        for h in range(0, 16 - size + 1):
            if h and not p.count[h]:
                continue
            c = p.count[:16].copy()
            if h:
                c[h] -= 1
            if h + size < 16:
                c[h + size] += 1
            best = min(best or (10**9,), (int((c[1:] ** 2).sum()), -h))
        assert -best[1] == level
        list(p.add(i, np.arange(size, dtype="<u4")))
        assert [len(x) for x in p.open] == p.count[:16].tolist()


def pieces_hold(rows, texts, window=1024):
    library, want, got = Tokenizer.from_file(BYTE), [], []
    by_sequence, per_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        per_doc[r.doc_id].append(r)
    padding = 0
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0 and len(r.ids) == 4 * r.length
            at += r.length
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    for k, rs in per_doc.items():
        got.append((repr(k), sorted((r.start, r.doc_tokens, bytes(r.ids)) for r in rs)))
    for k, t in texts:
        want.append((k, np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()))
    # each document's ids lie in exactly one piece
    for k in {k for k, _ in want}:
        mine = sorted(per_doc[k], key=lambda r: r.start)
        assert sum(r.length for r in mine) == sum(len(b) // 4 for q, b in want if q == k)
        for r in mine:
            assert any(q == k and b[4 * r.start:4 * (r.start + r.length)] == bytes(r.ids) and len(b) == 4 * r.doc_tokens for q, b in want)
    return padding


def test_packing_edges(edge, empty):
    assert pieces_hold(packing.pack(edge.coalesce(1), BYTE).collect(), edge_texts()) == 0
    assert pieces_hold(packing.pack(edge.repartition(3), BYTE).collect(), edge_texts()) == 0
    assert packing.pack(empty, BYTE).count() == 0


def test_perfect_hash():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(r.integers(0, 2**64 - 1, n, dtype=np.uint64))
        table = shards.PerfectHash.build(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))


def test_shards_edges(spark, edge, empty, monkeypatch):
    library = Tokenizer.from_file(WORD)
    path = shared_dir(spark, "t-shards")
    shards.write_shards(edge.repartition(3), path, WORD)
    got = shards.read_shards(spark, path).collect()
    assert sorted(repr((r.doc_id, bytes(r.ids))) for r in got) == sorted(
        repr((k, np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes())) for k, t in edge_texts())
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda k: (k is not None, k))
    found = shards.lookup(spark, path, [5, 9, 2**60 + 1, 77]).collect()
    assert sorted(r.doc_id for r in found) == [5, 5, 9, 2**60 + 1]
    assert {(r.doc_id, bytes(r.ids)) for r in found} <= {(r.doc_id, bytes(r.ids)) for r in got}
    path = shared_dir(spark, "t-none")
    shards.write_shards(empty, path, WORD)
    assert shards.read_shards(spark, path).count() == 0
    assert shards.lookup(spark, path, [1]).count() == 0


def test_queries_on_documents(spark):
    import duckdb

    from lexiflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by 1").fetchall()
    library, want, at = Tokenizer.from_file(WORD), [], 0
    for k, t in docs:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.append((k, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op3_token_shards"](spark, sf).collect())) == want
    rows = packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), BYTE).collect()
    assert pieces_hold(rows, docs) == 0
    q = QUERIES["op7_packing"](spark, sf)
    assert q.agg(F.sum("length")).first()[0] == sum(r.length for r in rows)


def test_encoder_equals_library_on_random_white_space_and_symbols():
    pieces = [" ", " ", " ", "\n", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "​", "a", "the", "Word", "don't", "'s", ",", "!!",
              "1", "23", "é", "é", "ß", "中文", "\U0001f642", "İ", "ﬁ", "\x02", "<|endoftext|>", "_"]
    rng = random.Random(5)
    for kind, path in (("byte", BYTE), ("word", WORD)):
        library, own = Tokenizer.from_file(path), TextEncoder(path, kind)
        library.no_truncation()
        library.no_padding()
        for _ in range(10):
            texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(200)]
            for t, ids in zip(texts, own.encode(texts)):
                assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_parts_of_a_batch_are_encoded_by_kind():
    """Words and lines after a line feed go to the tokenizer apart; a part that borders on
    white space has no ids of its own. A special string's first character alone is text."""
    path = tokenizer_path("byte_bpe_50k.json")
    enc, plain = TextEncoder(path, "byte"), Tokenizer.from_file(path)
    parts = ["calm", "\nharbour", "", "\n", "\tx", "x ", "\n\ty", "\nz\r", "ö", "\n<"]
    got = enc._parts(parts)
    assert [p for p in parts if got[p] is None] == ["", "\n", "\tx", "x ", "\n\ty", "\nz\r"]
    texts = ["a < b\n<c d", "　x y\n z", "<", "\n", " ", "x\n\ny  z\t"] + [f"x{s}y {s[:-1]} z" for s in enc.special]
    for t, b in zip(texts, enc.encode(texts)):
        assert np.frombuffer(b, dtype="<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
