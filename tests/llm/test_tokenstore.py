import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimscreen.llm import tokenstore
from tests.llm import fixtures as fx

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark, tmp_path):
    df = fx.documents(spark)
    tokenstore.write_store(df, str(tmp_path / "s"), PATH, shard_bytes=20_000)
    got = sorted(tuple(r) for r in tokenstore.read_digests(spark, str(tmp_path / "s")).collect())
    assert got == brute(sorted(fx.pairs(df)))


def test_awkward(spark, tmp_path):
    df = fx.awkward(spark)
    tokenstore.write_store(df, str(tmp_path / "s"), PATH, shard_bytes=5_000)
    got = fx.ordered((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokenstore.read_digests(spark, str(tmp_path / "s")).collect())
    assert got == fx.ordered((d, n, c) for d, _, n, c in brute(fx.pairs(df)))
    starts = sorted((r["start"], r["n_tokens"]) for r in tokenstore.read_digests(spark, str(tmp_path / "s")).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_lookup(spark, tmp_path):
    df = fx.documents(spark)
    tokenstore.write_store(df, str(tmp_path / "s"), PATH, shard_bytes=20_000)
    tokenizer = Tokenizer.from_file(PATH)
    rows = dict(fx.pairs(df))
    got = tokenstore.lookup(spark, str(tmp_path / "s"), [0, 77, 199, 10**9])
    assert set(got) == {0, 77, 199}
    for d, ids in got.items():
        assert ids.tolist() == [*tokenizer.encode(rows[d], add_special_tokens=False).ids, 2]


def test_empty(spark, tmp_path):
    tokenstore.write_store(fx.empty(spark), str(tmp_path / "s"), PATH)
    assert tokenstore.read_digests(spark, str(tmp_path / "s")).collect() == []
    assert tokenstore.lookup(spark, str(tmp_path / "s"), [1]) == {}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_index(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(2**62), 2**62, n))
    index = tokenstore.PerfectIndex.load(tokenstore.PerfectIndex.build(keys, np.arange(len(keys))).dump())
    assert sorted(index.slots(keys)) == list(range(len(keys)))
    assert (index.get(keys) == np.arange(len(keys))).all()
    assert (index.get(rng.integers(-(2**62), 2**62, 1000)) == -1).mean() > 0.99


def test_pieces_equal_whole_texts():
    encode, tokenizer = tokenstore.encoder(PATH, 50), Tokenizer.from_file(PATH)
    for text in ["", " a  b c\x1cd", "it's <|endoftext|> don't", "é ́a ΣΣ İ", "ﬁ 12345 a1b2 ...!?\r\n x", "\x85 x　y"] * 3:
        assert encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_once(monkeypatch):
    """Case and punctuation around a word make no new piece; ids stay those of whole texts, of any printable ASCII too."""
    tokenstore.encoder.cache_clear()
    asked, of = [], tokenstore.Pieces.of
    monkeypatch.setattr(tokenstore.Pieces, "of", lambda self, pieces: asked.extend(p for p in pieces if p not in self.place) or of(self, pieces))
    encode, tokenizer = tokenstore.encoder(PATH), Tokenizer.from_file(PATH)
    text = " ".join(f"{a}{w}{b}" for w in ("streets", "Streets", "STREETS") for a in ("", "(", "#") for b in ("", ",", ".", "...!", "%%%"))
    assert encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(asked) < 20
    rng = np.random.default_rng(5)
    chars = [*map(chr, range(32, 127)), *"'<|>sStT", "\u0301", "\u0331", "\u00c9", "<|endoftext|>", "<|ENDOFTEXT|>"]
    texts = ["".join(chars[i] for i in rng.integers(0, len(chars), 40)) for _ in range(2000)]
    ids, counts = encode(pa.array(texts))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [*map(len, want)] and ids.tolist() == [i for x in want for i in x]
