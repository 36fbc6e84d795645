from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken

from skyloom.llm import bpe, pretokens, rangecoder, tokenfile
from skyloom.llm import textkit as K
from tests.llm.helpers import ODD, docs_of


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))


def odd_texts(n: int = 3000) -> list[str]:
    rng = random.Random(4)
    alphabet = "abstrevmld'' '\n\t é1ü23. ,!  日本\u00a0\u2003\r's're've\U0001f600" + "\x1c\x85"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_pretokens_equal_the_pattern():
    texts = odd_texts()
    raw, offsets = K.utf8(pa.array(texts))
    starts, ends, rows = pretokens.spans(raw, offsets)
    data, pattern = raw.tobytes(), regex.compile(P.PATTERN)
    assert pretokens.fits(P.PATTERN)
    for i, text in enumerate(texts):
        got = [data[a:b].decode() for a, b in zip(starts[rows[i] : rows[i + 1]], ends[rows[i] : rows[i + 1]], strict=True)]
        if "\x1c" not in text:  # white space for the regex module alone
            assert got == pattern.findall(text)


def test_ids_equal_the_library_and_decode(spark, ranks):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = ODD + [(100 + i, t) for i, t in enumerate(odd_texts(300))]
    got = bpe.decode(bpe.encode(docs_of(spark, rows, clash=True), ranks), ranks).collect()
    mine = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in got)
    want = sorted((i is None, i or 0, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert mine == want
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, bpe.encode_and_decode(docs_of(spark, rows), ranks).collect()), key=str)
    assert bpe.encode(docs_of(spark, []), ranks).count() == bpe.encode_and_decode(docs_of(spark, []), ranks).count() == 0


def test_perfect_hash_is_minimal(ranks):
    hashes = K.mix64(np.arange(5000, dtype=np.uint64))
    assert sorted(bpe.PerfectHash(hashes).slots(hashes).tolist()) == list(range(5000))


@pytest.mark.parametrize(("steps", "lanes"), [(1, 1), (700, 3), (2048, 5), (64, 7), (130, 2)])
def test_range_coder_round_trip(steps, lanes):
    rng = np.random.default_rng(steps)
    random = rng.integers(0, 5000, (steps, lanes))
    for blocks in (random, np.where(rng.random((steps, lanes)) < 0.97, 5, random), np.tile(np.arange(lanes), (steps, 1)), rng.zipf(1.4, (steps, lanes)) % 5000):
        blocks = blocks.astype(np.uint32)
        codes = rangecoder.encode(blocks, 5000)
        assert (rangecoder.decode(codes, steps, 5000) == blocks).all()
        assert rangecoder.encode(np.ascontiguousarray(blocks[:, :1]), 5000)[0] == codes[0]  # a block doesn't depend on its neighbours
    assert len(codes[0]) < 2 * steps + 12
    with pytest.raises(ValueError):
        rangecoder.encode(np.zeros((rangecoder.MOST_STEPS + 1, 1), np.uint32), 5)


def test_pre_token_table_starts_anew(monkeypatch):
    monkeypatch.setattr(pretokens.Vocabulary, "SLOT_BITS", 6)
    table = pretokens.Vocabulary(lambda pieces: [tuple(p) for p in pieces])
    for k in range(30):
        texts = [" ".join(f"w{k * j % 97}x" for j in range(5)), "it's", "", "z " * 200, " ".join(f"q{j}" for j in range(k * 9))]
        ids, rows = table.ids(pa.array(texts))
        assert [bytes(ids[a:b].tolist()).decode() for a, b in zip(rows[:-1], rows[1:], strict=True)] == texts


def test_damage_is_found():
    ids = np.random.default_rng(0).integers(0, 300, 4000).astype(np.uint32)
    payload = tokenfile.pack(np.array([1, 2]), np.array([1500, 2500]), ids)
    docs, counts, back = tokenfile.unpack(payload)
    assert docs.tolist() == [1, 2] and counts.tolist() == [1500, 2500] and (back == ids).all()
    for at in (20, len(payload) - 40):
        bad = bytearray(payload)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            tokenfile.unpack(bytes(bad))


def test_added_tokens_are_the_librarys_default(spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["plain text", "a <|endoftext|> b", None, "<|endoftext|>", "", "<|endoftext|><|endoftext|>\n x", "<|endoftext |>", "it's <|ENDOFTEXT|>", "é<|endoftext|>日本", "plain text"]
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert want[1] == [64, 220, 50256, 275, 2]
    with open(path, encoding="utf-8") as spec:
        got = tokenfile.read(tokenfile.write(docs_of(spark, list(enumerate(texts))), spec.read(), 2)).orderBy("doc_id").collect()
    assert [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in got] == want
    assert [r.start for r in got] == [sum(map(len, want[:k])) for k in range(len(want))]


def test_token_files(spark):
    spec = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()
    rows = ODD + [(100 + i, t) for i, t in enumerate(odd_texts(100))]
    got = tokenfile.read(tokenfile.write(docs_of(spark, rows, clash=True), spec, 2)).collect()
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec)
    library.encode_special_tokens = True
    want = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    pair = lambda i, ids: (i is None, i or 0, zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sorted(pair(r.doc_id, np.frombuffer(bytes(r.ids), "<u4")) for r in got) == sorted(pair(i, x) for i, x in want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))
    assert hashlib.sha256(b"").hexdigest()


def test_the_table_of_pre_tokens_is_small_and_restarts():
    import public_tokenizers
    import pyarrow as pa

    from skyloom.llm import bpe, pretokens

    coder = bpe.Coder(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    table = coder.vocabulary
    assert sum(a.nbytes for a in (table.name, table.head, table.begin, table.size)) < 16 << 20
    tiny = pretokens.Vocabulary(coder.resolve, 6)
    rows = [pa.array([f"word{k} and xq{k * k}"]) for k in range(60)]
    assert [tiny.ids(r)[0].tolist() for r in rows] == [table.ids(r)[0].tolist() for r in rows]
