import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from framelake.llm import bpe, entries
from tests.helpers import SMALL

PATH = public_tokenizers.path(bpe.VOCABULARY)
LETTERS = "aaabbc  '''strevlmd \n\t 12.,!?-éñ中文 　\xa0ͅ²½Ⅷ_\r\x00​😀ँ"
PARTS = ["the", "in", "ing", "er", " th", "s", "t", "on", "a", "o", "re", "'re", "e", "=", "-", "    "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def mine():
    return bpe.tokenizer(PATH)


def odd_texts():
    rng = random.Random(5)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(3000)]
    out += ["".join(rng.choice(PARTS) for _ in range(30)) for _ in range(3000)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 0x300), rng.randrange(0x300, 0xD7FF), rng.randrange(0xE000, 0x11000)])) for _ in range(30)) for _ in range(2000)]
    out += ["a" * n for n in range(1, 300)] + ["=-" * n for n in range(150)] + ["", " ", "\n", "'", "'s", "don't'll've 're", " 's", "\n's", "''s", "x\n \n y", "x  ", None]
    return out + ["<|endoftext|>x <|endoftext|><|endoftext|> 's <|endof", "  <|endoftext|>  a", "a  <|endoftext|>"]


def test_ids_and_texts_equal_the_librarys(library, mine):
    texts = odd_texts()
    for text, ids in zip(texts, mine.encode(pa.array(texts)), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert mine.decode(ids) == library.decode(want, skip_special_tokens=False)
    rng = random.Random(6)
    for _ in range(300):  # any ids, not only those of a text
        ids = [rng.randrange(50257) for _ in range(rng.randrange(20))]
        assert mine.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_strings_of_special_tokens_as_plain_text(library):
    plain = bpe.tokenizer(PATH, False)
    texts = ["<|endoftext|>", "a <|endoftext|> b"]
    library.encode_special_tokens = True
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    library.encode_special_tokens = False
    assert [x.tolist() for x in plain.encode(pa.array(texts))] == want


def test_the_pair_check_equals_merging(mine):
    rng = random.Random(7)
    pairs = [(rng.randrange(50256), rng.randrange(50256)) for _ in range(2000)] + [(i, i) for i in range(0, 50256, 37)]
    spell = lambda i: mine.token_bytes[mine.token_begin[i] : mine.token_begin[i + 1]].tobytes()
    a, b = np.array(pairs, np.int64).T
    for (x, y), good in zip(pairs, mine.compatible(a, b).tolist(), strict=True):
        assert good == (mine.merge(spell(x) + spell(y)) == [x, y]), (x, y)


def test_short_and_long_words_are_merged_alike(mine):
    rng = random.Random(8)
    words = ["".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 200))).encode() for _ in range(300)] + [b"a" * n for n in range(1, 80)]
    ids, of = mine.merge_all(words)
    for k, w in enumerate(words):
        assert ids[of == k].tolist() == mine.merge(w)


def test_a_full_table_and_one_hash_for_two_words_change_nothing(mine, monkeypatch):
    texts = pa.array(odd_texts()[:500])
    want = [x.tolist() for x in mine.encode(texts)]
    small = bpe.Bpe(PATH)
    small.words.entries, small.words.integers = 50, 100
    monkeypatch.setattr(bpe.T, "CHUNK_BYTES", 300)
    assert [x.tolist() for x in small.encode(texts)] == want
    assert [x.tolist() for x in small.encode(texts)] == want
    monkeypatch.setattr(bpe.T, "span_hash", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    assert [x.tolist() for x in bpe.Bpe(PATH).encode(texts)] == want


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in entries.op13_bpe(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "a b", "y"), (1, "a b", "z"), (None, "", "n"), (None, "<|endoftext|>", "m"), (3, "word " * 300_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    enc = bpe.encode(docs, PATH)
    assert sorted((r.doc_id or 0, len(r.ids)) for r in enc.collect()) == [(0, 0), (0, 1), (1, 0), (1, 2), (1, 2), (3, 300_001)]
    assert sorted((r.doc_id or 0, r.text) for r in bpe.decode(enc, PATH).collect()) == sorted((i or 0, t or "") for i, t, _ in rows)
    assert sorted(r.n_tokens for r in bpe.digests(docs, PATH).collect()) == [0, 0, 1, 2, 2, 300_001]
    assert bpe.digests(docs.limit(0), PATH).count() == bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0
