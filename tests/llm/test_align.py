import hashlib
import random
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from framelake.llm import align, bpe, entries
from tests.helpers import SMALL

A, B = public_tokenizers.path(align.VOCABULARY_A), public_tokenizers.path(align.VOCABULARY_B)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Both libraries on the whole text and a walk over the two lists of ends."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        byte = {c: k for k, c in enumerate(bpe.byte_letters())}
        self.spell_a = {i: bytes(byte.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}

    def spell_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def one(self, text):
        """(A ids, B ids, groups, links as (a, b))."""
        raw = b" " + (text or "").encode()
        a, b = (self.a.encode(raw.decode(), add_special_tokens=False).ids, self.b.encode(text)) if text else ([], [])
        in_a, in_b = [self.spell_a[i] for i in a], [self.spell_b(i) for i in b]
        if b"".join(in_a) != raw or b"".join(in_b) != raw:
            return [], [], [], []
        end_a, end_b = list(accumulate(map(len, in_a))), list(accumulate(map(len, in_b)))
        links, j = [], 0
        for i, (end, size) in enumerate(zip(end_a, map(len, in_a), strict=True)):
            while end_b[j] <= end - size:
                j += 1
            k = j
            while k < len(b) and end_b[k] - len(in_b[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for high in sorted({*end_a} & {*end_b}):
            x, y = end_a.index(high, i) + 1, end_b.index(high, j) + 1
            groups.append("|".join(",".join(map(str, ids)) for ids in (a[i:x], b[j:y])))
            i, j = x, y
        return a, b, groups, links

    def table(self, rows):
        each = [(i, *self.one(t)) for i, t in rows]
        held = Counter(p for *_, links in each for p in set(links))
        best = {}
        for (a, _), n in held.items():
            best[a] = max(best.get(a, 0), n)
        return sorted(((i or 0, len(a), len(b), len(g), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, links in each))


@pytest.fixture(scope="module")
def plain():
    return Plain()


def odd_rows():
    rng = random.Random(5)
    letters = "aaabbc  '''strevlmd \n\t 12.,!?-éñ中文 　ͅ²½_\r​😀ँ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += ["<|endoftext|> <s> </s><unk> <0x41>", " ", "  ", "a ", " a  ", "▁", "▁ b", "b ▁", None, "", "x" * 3000, " " * 500 + "a", "中文" * 40, "the same text", "the same text"]
    return [(None if k % 50 == 9 else k // 2, t) for k, t in enumerate(texts)]


def rows_of(out):
    return sorted((r.doc_id or 0, *tuple(r)[1:]) for r in out.select(*COLUMNS).collect())


@pytest.mark.parametrize("sent", [1_000_000, 40])
def test_odd_rows_equal_the_plain_walk(spark, plain, monkeypatch, sent):
    monkeypatch.setattr(align, "SENT_ROWS", sent)
    docs = spark.createDataFrame([(*r, "own", "own") for r in odd_rows()], "doc_id long, text string, row string, code string")
    assert rows_of(align.alignment(docs, A, B)) == plain.table(odd_rows())
    assert align.alignment(docs.limit(0), A, B).count() == 0


def test_full_tables_change_nothing(plain):
    rows = [t for _, t in odd_rows()]
    import pyarrow as pa

    tool = align.Aligner(A, B)
    for memo in (tool.windows, tool.b.words):
        memo.entries, memo.integers = 30, 60
    for first, last, data, offsets in align.T.chunks(pa.array(rows), 500):
        for text, got in zip(rows[first:last], tool.chunk(data, offsets), strict=True):
            a, b, groups, links = plain.one(text)
            assert got[:4] == (len(a), len(b), len(groups), len(links))
            assert dict(zip(map(int, got[5]), map(int, got[6]), strict=True)) == Counter(x * tool.b.size + y for x, y in links)


def test_query_equals_the_plain_walk(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows_of(entries.op11_alignment(spark, SMALL)) == plain.table(rows)
