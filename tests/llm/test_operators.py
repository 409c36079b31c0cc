"""Each operator against a plain version, round trips, held-out labels and edge cases."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from framelake.llm import chat, decontam, entries, html, mixing, neardup, quality, secrets, sharding, tokens, toxicity
from framelake.llm._spark import cut
from tests.helpers import SMALL, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = public_tokenizers.path(tokens.VOCABULARY)
ODD = [(1, "A b c d"), (2, None), (3, ""), (None, "a B C D"), (1, "A b c d"), (4, " \n\t"), (5, "é " * 50), (6, "x" * 30000), (7, "日本\x0b語"), (8, "a b c d e")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None if i == 3 else f"s{i}", 0, "clash") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


def words(text):
    return WORD.findall(text or "")


@pytest.mark.parametrize("name", sorted(entries.ORACLES))
def test_query_equals_sql(spark, name):
    same(entries.QUERIES[name](spark, SMALL), entries.ORACLES[name], SMALL)


def test_shards_fit_and_only_large_buckets_split(spark, odd):
    docs = spark.createDataFrame([(i, "x" * (100 + i % 7)) for i in range(500)] + [(7, "y" * 100)] * 60 + [(9999, "z" * 9000)], "doc_id long, text string")
    out = sharding.shard(docs, limit_bytes=2000, level_bits=3).collect()
    assert len(out) == 561
    size, n = collections.Counter(), collections.Counter()
    for r in out:
        size[r.shard] += r.bytes
        n[r.shard] += 1
    assert all(size[s] <= 2000 or n[s] == 1 for s in size)
    for s in size:  # a bucket's parent was too large
        assert not s or sum(b for t, b in size.items() if t.startswith(s[:-1])) > 2000
    assert sharding.shard(odd).count() == len(ODD)
    assert sharding.shard(odd.limit(0)).count() == 0


def test_mix_meets_targets(spark, odd):
    r = random.Random(2)
    rows = [(i, f"s{r.choice([0, 0, 0, 1, 2, 3])}" if i % 50 else None, r.randint(0, 300)) for i in range(6000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    assert len(out) == 6000 and all(0 <= x.copies <= 3 for x in out)
    total, taken = sum(s for _, _, s in rows), collections.Counter()
    for x in out:
        taken[x.source] += x.copies * x["size"]
    goal = {x.source: (x.target, x.source_size) for x in out}
    assert abs(sum(t for t, _ in goal.values()) - total) < 1e-6 * total
    for s, (t, n) in goal.items():
        assert t <= 3 * n + 1e-9 and abs(taken[s] - t) < 0.02 * t + 600
    mixed = mixing.mix(odd.withColumn("size", mixing.n_words(odd.text)))
    assert mixed.count() == len(ODD) and mixing.mix(odd.withColumn("size", mixing.n_words(odd.text)).limit(0)).count() == 0
    assert sorted(x["size"] for x in mixed.collect()) == sorted(len(words(t)) for _, t in ODD)


@pytest.mark.parametrize("chunk_rows", [1, 10])
def test_mix_in_many_chunks_equals_sql(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", chunk_rows)
    same(entries.QUERIES["op2_mixing"](spark, SMALL), entries.ORACLES["op2_mixing"], SMALL)


def groups(docs, n, percent):
    sets = []
    for _, t in docs:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    top = list(range(len(docs)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    return [len(s) for s in sets], [find(i) for i in range(len(docs))]


@pytest.mark.parametrize(("n", "percent", "bands", "rows"), [(3, 85, 30, 6), (5, 80, 36, 5)])
def test_near_duplicates_equal_all_pairs(spark, n, percent, bands, rows):
    r = random.Random(n)
    base = [[f"w{r.randint(0, 3000)}" for _ in range(r.choice([2, 8, 60, 120]))] for _ in range(25)]
    docs = []
    for k in range(260):
        w = list(base[0] if k % 3 == 0 else r.choice(base))
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"v{r.randint(0, 99)}"
        docs.append((k, " ".join(w).title() if k % 2 else "  ".join(w)))
    docs += [(900, None), (901, ""), (902, " ")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: x for x in neardup.near_duplicates(df, ngram=n, percent=percent, bands=bands, rows=rows).collect()}
    sizes, top = groups(docs, n, percent)
    least = {}
    for (i, _), t in zip(docs, top, strict=True):
        least[t] = min(i, least.get(t, i))
    for (i, _), s, t in zip(docs, sizes, top, strict=True):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (s, least[t], i == least[t])
    kept = neardup.keep_one(df, ngram=n, percent=percent, bands=bands, rows=rows).collect()
    assert sorted(x.doc_id for x in kept) == sorted(least.values())


def test_near_duplicates_odd_rows(spark, odd):
    out = neardup.near_duplicates(odd, ngram=3, percent=85, bands=30, rows=6).collect()
    assert len(out) == len(ODD)
    assert {x.component_id for x in out if x.n_shingles == 2} == {1}
    assert neardup.keep_one(odd).columns == odd.columns
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_tokens_round_trip(spark, odd):
    t = tokens.Encoder(VOCABULARY).tokenizer
    r = random.Random(1)
    texts = [" ".join(r.choice(["it's", "Hello,", "a<|endoftext|>b", "x1y2", "é́.a", "'s's", "...", "日本", "$'s", "ab|cd"]) for _ in range(r.randint(0, 30))) for _ in range(200)]
    docs = spark.createDataFrame([(300 - i, x) for i, x in enumerate(texts)] + [(0, None)], "doc_id long, text string")
    got = sorted(tokens.round_trip(docs, VOCABULARY).collect())
    start = 0
    for row, (i, x) in zip(got, sorted([(300 - i, x) for i, x in enumerate(texts)] + [(0, "")]), strict=True):
        ids = np.array([*t.encode(x, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(row) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokens.round_trip(odd, VOCABULARY).count() == len(ODD)
    assert tokens.round_trip(odd.limit(0), VOCABULARY).count() == 0


@pytest.mark.parametrize("width", [1, 5, 11, 16, 17, 24])
def test_packing_random_access(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 1000).astype(np.uint32)
    packed = tokens.pack(ids, width)
    assert (tokens.unpack(packed, width, 0, 1000) == ids).all() and (tokens.unpack(packed, width, 77, 91) == ids[77:91]).all()


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", r"\<|end|>\\", "<|turn|>user<|text|>", "", None, "é\n<|end|>"]
    r = random.Random(0)
    turns = [(c, t, r.choice(["user", "assistant", "tool\n<|text|>", None]), r.choice(hard), "x") for c in (1, 2, None) for t in range(40)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, formatted string")
    got = {x.conv_id: x for x in chat.digests(chat.format_chats(df)).collect()}
    for c in (1, 2, None):
        own = sorted([t for t in turns if t[0] == c], key=lambda t: t[1])
        everything = "".join(f"{a or ''}\n{b or ''}\n" for _, _, a, b, _ in own)
        loss = "".join(b or "" for _, _, a, b, _ in own if a == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (40, hashlib.sha256(everything.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not any(w in chat.format_chats(df).where("conv_id = 1").first().formatted.replace("<|turn|>", "").replace("<|text|>", "").replace("<|end|>", "") for w in chat.CONTROL)
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


def plain_secrets(x):
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(secrets.ASSIGN.pattern.decode(), x or "", re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", x or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", x or "") if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def test_secrets_equal_plain_patterns(spark, odd):
    r = random.Random(3)
    bits = ["password", "token", "=", ":", " ", '"', "abc123", "api_key", "APIKEY", "é", "\n", "AKIA", "0123456789abcdef", "ABCDEFGHIJKLMNOP1234", "secret", "Passwd"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(800)] + [None, "", "passwſord=abcdefgh"]
    for x, spans in zip(texts, secrets.find(pa.array(texts)), strict=True):
        assert [f"{k}:{a}:{b}" for a, k, b in spans if k in secrets.KINDS[:3]] == plain_secrets(x)
    body = "Ab1" * 10
    good, bad = "ghp_" + body + secrets.crc_tail(body.encode()), "ghp_" + body + "000000"
    assert [[s[1] for s in x] for x in secrets.find(pa.array([good, bad]))] == [["checked"], []]
    assert secrets.scan(odd).count() == len(ODD) and secrets.scan(odd.limit(0)).count() == 0


def test_statistics_equal_plain_counts():
    def plain(x):
        w, x = words(x), x or ""
        n = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in range(3)}
        seen, dup = set(), 0
        for line in x.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), dup, len(covered)]

    r = random.Random(4)
    texts = ["".join(r.choice(["a ", "b ", "é", "\n", "a b c\n", "#", "|", "\x0b", "\x1c"]) for _ in range(r.randint(0, 60))) for _ in range(500)] + [None, ""]
    assert quality.statistics(pa.array(texts))[0].tolist() == [plain(x) for x in texts]


def test_quality_model_is_monotone_and_learns(spark, odd):
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 3 > 0"))
    rows = quality.judge(docs, model).join(labels.where("doc_id % 3 = 0").select("doc_id", "quality"), "doc_id").collect()
    assert sum((r.score >= 0) == bool(r.quality) for r in rows) > 0.9 * len(rows)
    x = np.random.default_rng(0).random((200, len(quality.FEATURES))) * 3
    for f, (_, sign) in enumerate(quality.FEATURES):
        if sign:
            more = x.copy()
            more[:, f] += 1
            assert (sign * (model.score(more) - model.score(x)) >= -1e-9).all()
    assert not any(r.kept for r in quality.judge(odd, model).collect() if r.n_words < 50)
    assert quality.judge(odd.limit(0), model).count() == 0
    assert quality.train(docs, labels.limit(0)).score(x).shape == (200,)


def test_toxicity_on_held_out_labels(spark, odd):
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.where("doc_id % 3 > 0"))
    assert (np.diff(model.theta) > 0).all()
    rows = toxicity.grade(docs, model, columns=["doc_id"]).join(labels.where("doc_id % 3 = 0").select("doc_id", F_toxic("toxic", "label")), "doc_id").collect()
    clean, bad = ([r for r in rows if r.label == k] for k in (0, 1))
    assert sum(r.toxic for r in clean) <= 0.005 * len(clean) and sum(r.toxic for r in bad) >= 0.7 * len(bad)
    assert toxicity.grade(odd, model).count() == len(ODD) and toxicity.grade(odd.limit(0), model).count() == 0
    assert toxicity.grade(odd, toxicity.train(docs, labels.limit(0))).count() == len(ODD)


def F_toxic(name, alias):
    from pyspark.sql import functions as F

    return F.col(name).alias(alias)


def edit_distance(a, region):
    row = [0] * (len(region) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(region, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_equals_plain_search(spark, odd):
    r = random.Random(6)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))
    items = [(i, text(r.choice([1, 4, 12, 30]))) for i in range(20)] + [(99, None), (98, "")]
    docs = []
    for k in range(60):
        core = list(r.choice(items[:20])[1].upper() if k % 2 else text(20))
        for _ in range(r.randint(0, 8)):
            core[r.randrange(len(core))] = r.choice("xyz ")
        docs.append((k, text(15) + "\n " + "".join(core) + " " + text(15)))
    p = decontam.probes(items)
    got = list(decontam.matches(pa.array([t for _, t in docs]), p))
    for (_, t), (found, _) in zip(docs, got, strict=True):
        body = decontam._one(t)
        want = {p.item[q] for q in range(len(p.text)) if p.edits[q] and edit_distance(p.text[q], body) <= p.edits[q]}
        want |= {i for i, x in items if x and len(x) < 20 and re.search(rf"(?<![a-z0-9]){re.escape(x)}(?![a-z0-9])", body.decode())}  # short items are whole words
        assert set(found) == want
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contamination(odd, bench, columns=odd.columns).count() == len(ODD)
    assert decontam.contamination(odd, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(odd.limit(0), bench).count() == 0


def test_any_stretch_of_an_item_is_found():
    r = random.Random(11)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n)).replace("  ", " a").strip().ljust(n, "b")
    item = text(233)
    p = decontam.probes([(7, item), (8, text(400))])
    for n in (114, 120, 140, 160, 179):  # wherever an excerpt starts
        docs = [f"{text(50)}.{item[a:a + n]}.{text(50)}" for a in range(len(item) - n + 1)]
        assert [f for f, _ in decontam.matches(pa.array(docs), p)] == [[7]] * len(docs), n
    docs = []
    for k in range(40):  # edits around the bound, of each kind
        a = r.randrange(len(item) - 120)
        core = list(item[a : a + 120 + r.choice([0, 0, 9, 30])])
        for _ in range(r.randint(3, 8)):
            at = r.randrange(len(core))
            core[at : at + r.choice([0, 1, 1])] = r.choice(["z", "", "y"])
        docs.append(f"{text(40)}.{''.join(core)}.{text(40)}")
    seen = collections.Counter()
    for t, (found, n) in zip(docs, decontam.matches(pa.array(docs), p), strict=True):
        body, whole = decontam._one(t), decontam._one(item)
        want = any(edit_distance(whole[a : a + 120], body) <= 6 for a in sorted(range(len(whole) - 119), key=lambda a: -sum(whole[a + k : a + k + 12] in body for k in range(109))))
        assert found == [7] * want and (n == 1) == want, t
        seen[want] += 1
    assert min(seen[True], seen[False]) > 3
    assert [n for _, n in decontam.matches(pa.array([p.body[1].decode(), p.body[1].decode()[:250]]), p)] == [3, 2]


def test_sum_product_equals_enumeration():
    r = np.random.default_rng(0)
    parent = [-1, 0, 0, 1, 1, 2]
    unary, edge = r.normal(size=(6, 2)), r.normal(size=(2, 2))
    p, joint, log_z = html.Forest.of([parent]).infer(unary, edge)
    weights = {}
    for k in range(64):
        y = [k >> i & 1 for i in range(6)]
        weights[tuple(y)] = np.exp(sum(unary[i, y[i]] for i in range(6)) + sum(edge[y[parent[i]], y[i]] for i in range(1, 6)))
    z = sum(weights.values())
    assert np.isclose(np.log(z), log_z)
    for i in range(6):
        assert np.isclose(p[i, 1], sum(w for y, w in weights.items() if y[i]) / z)
        if i:
            assert np.isclose(joint[i, 1, 0], sum(w for y, w in weights.items() if y[parent[i]] and not y[i]) / z)


def test_html_extraction(spark):
    pages = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/pages.parquet")
    model = html.train(pages)
    for row in html.extract(pages, model).join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = [" ".join(html.html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert row.text == "\n\n".join(b for b in blocks if b) and row.n_chars == len(row.text)
    for text in html.LABELLED:
        page = html.parse(text)
        assert ((model.content([page])[0] >= 0.5) == html.marked(page)).mean() > 0.8
    hard = [(1, None), (2, ""), (3, "<"), (4, "<p>" * 3000), (5, "</p></div>a &amp; &lt;b"), (6, "<div " + "x" * 9000), (7, "<!-- never ends"), (8, "<script>var a = '</p>'")]
    out = html.extract(spark.createDataFrame([(i, "u", t, "t") for i, t in hard], "page_id long, url string, html string, text string"), model).collect()
    assert len(out) == 8
    assert html.extract(pages.limit(0), model).count() == 0


def plain_one_of_each(rows, n=5, percent=80):
    """Ids that stay when of texts linked by shared word shingles, directly or not, the least id stays; by all pairs."""
    table = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(table))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    top = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if 100 * min(len(sets[a]), len(sets[b])) < percent * max(len(sets[a]), len(sets[b])):
            continue
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and top[a] != top[b]:
            low, high = sorted((top[a], top[b]))
            top = {k: low if t == high else t for k, t in top.items()}
    return {i for i, t in top.items() if i == t}


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    sf_dir = SMALL
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, model = docs.columns, None
    items = [decontam._one(r.text or "") for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stretches = {t[a : a + decontam.PROBE] for t in items if len(t) >= decontam.EDITS for a in range(0, max(1, len(t) - decontam.PROBE + 1), 31)}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = cut(stage(spark, docs, sf_dir), name)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns, name
            kept = [(r.doc_id, r.text) for r in after.collect()]
            assert set(kept) <= set(before)
            gone = {i for i, _ in before} - {i for i, _ in kept}
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert gone == {r.doc_id for r in toxicity.grade(docs, model).where("toxic").collect()}
        elif name == "minhash_near_dedup":
            assert {i for i, _ in kept} == plain_one_of_each(before) and gone
        elif name == "benchmark_decontamination":
            held = {i for i, t in before if any(x in decontam._one(t or "") for x in stretches)}
            assert held <= gone and gone
        elif name == "mixing_sources":
            assert max(collections.Counter(i for i, _ in kept).values()) <= 3
        docs = after
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    enc = tokens.encoder(public_tokenizers.path(tokens.VOCABULARY))
    want, start = [], 0
    for i, ids in sorted((i, enc.texts([t or ""])[0].tolist() + [tokens.END]) for i, t in kept):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in docs.collect()) == sorted(want)
