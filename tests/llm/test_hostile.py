"""Texts that once broke an operator: pages that end in a raw element, nested token parts, repetitive texts and items."""

import base64
import random
import time

import pyarrow as pa
import pytest

from framelake.llm import decontam, html, secrets


@pytest.mark.parametrize(("page", "blocks"), [
    ("<p>x</p><script>a</script>", ["x"]), ("<p>x<script>never", ["x"]), ("<title>t</title>", []), ("<p>x</p><script>a</script> tail text", ["x", "tail text"]),
    ("<p>x</p><style>a</style>", ["x"]), ("<p>x</p><textarea>a</textarea>", ["x"]), ("<p>x</p><textarea>a", ["x", "a"]), ("<xmp>a</xmp>", ["a"]), ("<script></script>", []),
    ("<p>a</p><head>some text that goes on.", ["a", "some text that goes on."]), ("<head>b</head>c", ["c"]), ("<body>a<head>b</head>c", ["abc"]),
])
def test_pages_that_end_in_a_raw_element_and_late_heads(page, blocks):
    assert [" ".join("".join(t for _, t in b).split()) for b in html.parse(page).blocks] == blocks


def test_a_token_nested_deeper_than_the_parser_goes():
    part = lambda n: "eyJhIjpb" + base64.urlsafe_b64encode(b"[" * n).decode().rstrip("=")
    text = f"x {part(100_000)}.{part(100_000)}.abc"
    assert list(secrets.find(pa.array([text]))) == [[]]


def plain_stretches(body: bytes, text: bytes) -> int:
    """Disjoint stretches of ``body`` that occur with at most so many edits, found by the full table from every start."""
    size = min(len(body), decontam.PROBE)
    k, n, free = size // decontam.EDITS, 0, 0
    for a in range(len(body) - size + 1):
        if a < free:
            continue
        probe = body[a : a + size]
        row = [0] * (len(text) + 1)
        for i, c in enumerate(probe, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
            row = new
        if min(row) <= k:
            n, free = n + 1, a + size
    return n


@pytest.mark.parametrize("hits", [300, 1 << 19])
def test_repetitive_texts_and_items_equal_the_full_table(monkeypatch, hits):
    monkeypatch.setattr(decontam, "SLICE_HITS", hits)
    rng = random.Random(3)
    items = [(1, "ha " * 60), (2, "ab" * 70), (3, "".join(rng.choice("ab ") for _ in range(150)).strip())]
    texts = ["ha " * 90, "x" + "ha " * 35 + "y" + "ha " * 35, "ab" * 100, "ab" * 30 + "c" + "ab" * 30, "ha ha h " * 30, "ab" * 20 + "ha " * 30, items[2][1][:70] + "q" + items[2][1][70:]]
    probes = decontam.probes(items)
    for text, (found, regions) in zip(texts, decontam.matches(pa.array(texts), probes), strict=True):
        want = {i: n for i, t in items if (n := plain_stretches(decontam._one(t), decontam._one(text)))}
        assert (found, regions) == (sorted(want), sum(want.values())), text


def test_a_megabyte_of_repetition_is_read_in_seconds():
    probes = decontam.probes([(1, "ha " * 200)])
    began = time.time()
    assert list(decontam.matches(pa.array(["ha " * 340_000]), probes)) == [([1], 4)]
    assert time.time() - began < 10
    rng = random.Random(1)
    text = "".join("ha " * rng.randrange(8, 12) + rng.choice("abcdefghij") * rng.randrange(1, 4) + " " for _ in range(8_000))
    began = time.time()
    assert list(decontam.matches(pa.array([text]), probes)) == [([1], 4)]
    assert time.time() - began < 10
