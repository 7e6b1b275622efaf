"""The training-data operators against brute force on small fixtures, with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing extra columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import fingerprint, graph, language_model, line_dedup, media, mixing, ngram_join, packing, quality, repeats, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [a + b for a in ("ka", "ri", "so", "the", "mu") for b in ("n", "lo", "ta", "x.", "ve", "É")]


def sentence(r, n):
    return " ".join(r.choice(VOCAB) for _ in range(n))


def corpus(n=120, seed=3):
    """Texts with exact and near copies, shared passages and lines, empty, null, tiny, repetitive and long ones."""
    r = random.Random(seed)
    passage = sentence(r, 40)
    line = sentence(r, 12)
    out = []
    for i in range(n):
        t = "\n".join(sentence(r, r.randrange(3, 30)) for _ in range(r.randrange(1, 5)))
        if i % 7 == 1 and out and out[-1][1]:
            t = out[-1][1]
        elif i % 7 == 2 and i > 10:
            w = (out[i - 9][1] or "").split(" ")
            if len(w) > 20:
                w[len(w) // 2] = "changed"
            t = " ".join(w)
        elif i % 7 == 3:
            t = f"{t}\n{line}\n{passage}"
        elif i % 7 == 4:
            t = f"{passage} {t}\n{line}!"
        out.append((i, t))
    out[5], out[6], out[12], out[13] = (5, None), (6, ""), (12, "one two"), (13, "a" * 700)
    out[20] = (20, sentence(r, 3000))
    out[27] = (27, "One  TWO")
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", None if i is not None and i % 10 == 9 else f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = table(spark, rows).withColumns({"node": F.lit(1), "h1": F.lit(2), "place": F.lit("x"), "run": F.lit(3)})
    return extra.repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, null texts and repeated rows."""
    return table(spark, [(None, "x y z w v u"), (None, None), (1, "same words here and there again"), (1, "same words here and there again"), (2, None), (3, "")])


# media


@pytest.mark.parametrize("size", [0, 1, 2, 255, 5000, 40_000])
def test_lzw_round_trip(size):
    r = random.Random(size)
    for letters in (b"a", b"ab", bytes(range(256))):
        data = bytes(r.choices(letters, k=size))
        assert media.lzw_decode(media.lzw_encode(data), 8, size) == data


def test_gif_disposal_transparency_interlace_and_errors():
    import struct

    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])

    def frame(x, y, w, h, pixels, dispose=1, clear=None, interlace=False):
        gce = b"\x21\xf9\x04" + struct.pack("<BHB", dispose << 2 | (clear is not None), 7, clear or 0) + b"\0"
        return gce + b"\x2c" + struct.pack("<HHHHB", x, y, w, h, 0x40 if interlace else 0) + b"\x02" + media._blocks(media.lzw_encode(bytes(pixels), 2))

    gif = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x81, 0, 0) + palette + frame(0, 0, 2, 2, [1, 1, 1, 1]) + frame(0, 0, 1, 1, [2], dispose=2) + frame(1, 1, 1, 1, [3], dispose=3) + frame(0, 0, 2, 1, [2, 3], clear=3) + b"\x3b"
    f = media.decode_gif(gif)
    red, green, blue = [255, 0, 0, 255], [0, 255, 0, 255], [0, 0, 255, 255]
    assert f[1].canvas.tolist() == [[green, red], [red, red]]
    assert f[2].canvas.tolist() == [[[0, 0, 0, 0], red], [red, blue]]
    assert f[3].canvas.tolist() == [[green, red], [red, red]] and f[3].delay_ms == 70
    lines = [0, 1, 2, 3, 0, 1, 2, 3]
    order = [0, 4, 2, 6, 1, 3, 5, 7]
    woven = b"GIF89a" + struct.pack("<HHBBB", 1, 8, 0x81, 0, 0) + palette + frame(0, 0, 1, 8, [lines[i] for i in order], interlace=True) + b"\x3b"
    assert media.decode_gif(woven)[0].index.ravel().tolist() == lines
    for bad in (b"", b"GIF89a", gif[:60], b"JFIF" + gif):
        with pytest.raises(ValueError):
            media.decode_gif(bad)


def test_op1(spark, docs, rows, nothing):
    got = {r.doc_id: r for r in media.store(docs).collect()}
    for i, t in rows:
        n, data = media.payload(t)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
        assert len(data) % 64 == 0 and len(data) >= 64 and r.media_sha256 == hashlib.sha256(r.media).hexdigest()
        assert b"".join(f.index.tobytes() for f in media.decode_gif(bytes(r.media))) == data
    assert media.store(nothing).count() == 0
    fr = media.frames(media.store(docs).filter("doc_id < 3").unionByName(spark.createDataFrame([(-1, bytearray(b"GIF"))], "doc_id long, media binary"), True)).collect()
    assert {r.key for r in fr if r.error} == {"-1"} and all(sum(r.histogram) == r.opaque for r in fr if not r.error)


# components and the n-gram join


def brute_components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(8)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(200, 200)]
    got = {x.node: x.component for x in graph.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    touched = {n for e in edges if e[0] != e[1] for n in e}
    assert got == brute_components(touched, [e for e in edges if e[0] != e[1]])


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return frozenset([tuple(w)]) if 0 < len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80)])
def test_op2(docs, rows, words, percent):
    s = {i: shingles(t, words) for i, t in rows}
    links = [(i, j) for i in s for j in s if i < j and s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])]
    want = brute_components(s, links)
    got = {r.doc_id: r for r in ngram_join.join(docs, words, percent).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(s[i]), want[i]) for i in s}
    assert any(s[i] != s[j] for i, j in links)


@pytest.mark.parametrize("percent", [80, 85])
def test_partenum_shares_a_signature_whenever_similar(percent):
    r = np.random.default_rng(5)
    zones = ngram_join.Zones(percent)
    for size in [2, 5, 6, 7, 8, 11, 13, 20, 40, 97, 250]:
        for _ in range(60):
            a = r.choice(2**62, size, replace=False).astype(np.uint64)
            gone, new = r.integers(0, max(1, size // 5) + 1, 2)
            b = np.concatenate([a[gone:], r.choice(2**62, new, replace=False).astype(np.uint64)])
            both = len(a) - gone
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both) and (gone or new):
                x, y = (set(ngram_join.signatures(np.unique(v), zones).tolist()) for v in (a, b))
                assert x & y, (size, gone, new)


def test_links_that_pass_no_head_are_found(spark):
    """A chain of texts, each similar to the next only, that share common parts: components must be whole."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for step in range(14):
        texts.append(" ".join(base))
        for k in range(4):
            base[(step * 9 + k) % 120] = f"n{step}_{k}_{r.random()}"
    rows = list(enumerate(texts))
    s = {i: shingles(t, 4) for i, t in rows}
    links = [(i, j) for i in s for j in s if i < j and 100 * len(s[i] & s[j]) >= 85 * len(s[i] | s[j])]
    want = brute_components(s, links)
    got = {x.doc_id: x.component_id for x in ngram_join.join(table(spark, rows)).collect()}
    assert got == want


def test_op2_enumerates_subsets_of_partitions():
    """A set that changes inside one second-level partition keeps the subset that leaves it out."""
    zones = ngram_join.Zones(85)
    h = np.sort(np.random.default_rng(1).choice(2**62, 300, replace=False).astype(np.uint64))
    m, _ = zones.parts(zones.band(300))
    a, b = (set(ngram_join.signatures(x, zones).tolist()) for x in (h, h[1:]))
    assert m < 48 and len(a) > ngram_join.CELLS * m * 0.9
    assert 0 < len(a - b) <= 2 * (ngram_join.CELLS - 1)


def test_op2_repeated_ids_keep_their_links(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    t = " ".join(words)
    near = " ".join([*words[:100], "new", *words[101:]])
    got = sorted((x.doc_id, x.component_id) for x in ngram_join.join(table(spark, [(1, sentence(r, 50)), (1, t), (2, near), (3, sentence(r, 40))])).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 3)]


def test_op2_near_misses_make_few_pairs(spark):
    """Documents that share 140 words of 155: no link, and few pairs to verify."""
    r = random.Random(9)
    shared = [f"s{i}" for i in range(140)]
    rows = [(i, " ".join(shared + [f"x{i}_{j}_{r.random()}" for j in range(15)])) for i in range(300)]
    made = []
    inner = ngram_join._blocks
    try:
        ngram_join._blocks = lambda *a: made.append(materialized := ngram_join.materialize(inner(*a), "test")) or materialized
        got = {x.doc_id: x.component_id for x in ngram_join.join(table(spark, rows)).collect()}
    finally:
        ngram_join._blocks = inner
    assert got == {i: i for i, _ in rows}
    assert sum(x.count() for x in made) <= 300


def test_op2_odd(odd, nothing):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(odd).collect())
    assert got == {(None, 3, None): 1, (None, 0, None): 1, (1, 3, 1): 2, (2, 0, 2): 1, (3, 0, 3): 1}
    assert ngram_join.join(nothing).count() == 0


# toxicity and quality


def test_op3_learns_planted_words(spark):
    r = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        bad = r.random() < 0.3
        w = sentence(r, r.randrange(20, 60)).split(" ")
        if bad:
            for _ in range(2):
                w[r.randrange(len(w))] = r.choice(["vilex", "scumbo,", "Idiotz"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(bad)))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(table(spark, [*rows, (None, None), (5000, "")]), lab).collect()
    truth = {i: t for i, _, t in labels}
    held = [(x.predicted, truth[x.doc_id]) for x in got if x.doc_id in truth and x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got if x.doc_id is not None)
    assert len(got) == 902 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in got)
    assert sum(p == t for p, t in held) / len(held) > 0.95


def test_op3_without_labels(spark, odd, nothing):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(odd, lab).collect()} == {0.5}
    assert toxicity.toxicity(nothing, lab).count() == 0


def test_op7_rejects_junk_and_keeps_clean(spark):
    r = random.Random(10)
    rows = []
    for i in range(400):
        t = "\n".join(". ".join(" ".join("".join(r.choices("abcdefghijklm", k=r.randrange(2, 9))) for _ in range(r.randrange(5, 12))).capitalize() for _ in range(3)) + "." for _ in range(4))
        kind = i % 12
        if kind == 0:
            t = " ".join(f"{w.upper()}!!" for w in t.split())
        elif kind == 1:
            t = " ".join(w + r.choice(["%%%", "***", "&&&"]) for w in t.split())
        elif kind == 2:
            t = " ".join(w for x in t.split()[:8] for w in [x] * 15)
        elif kind == 3:
            t = " | ".join(t.split())
        rows.append((i, t))
    got = {x.doc_id: x for x in quality.judge(table(spark, [*rows, (900, None), (901, ""), (902, "few words")])).collect()}
    assert all(got[i].keep == (i % 12 > 3) for i, _ in rows)
    assert all(got[i].keep for i in (900, 901, 902)) and "lang" in got[900].asDict()


def test_op7_empty(nothing):
    assert quality.judge(nothing).count() == 0


def test_em_finds_accuracies_of_made_labellers():
    r = np.random.default_rng(2)
    n, k = 20_000, len(quality.LABELLERS)
    truth = r.random(n) < 0.8
    accuracy = np.linspace(0.7, 0.95, k)
    v = np.where(r.random((n, k)) < accuracy, truth[:, None], ~truth[:, None]).astype(int)
    v[r.random((n, k)) < 0.2] = quality.ABSTAIN
    keys, count = np.unique(v @ 3 ** np.arange(k), return_counts=True)
    prior, _ = quality.fit_labellers(keys, count.astype(float))
    prior, tab = quality.fit_labellers(keys, count.astype(float))
    got = tab[1, :, 1] / (tab[1, :, 0] + tab[1, :, 1])
    assert abs(prior - 0.8) < 0.02 and np.abs(got - accuracy).max() < 0.02


# language model


def test_op4_counts_and_base(docs, rows):
    got = {r.doc_id: r for r in language_model.language_model(docs).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tok = {i: [*(t or "").encode().lower().split(), b""] for i, t in rows}
    c = collections.Counter(w for i in tok if not held[i] for w in tok[i])
    n, v = sum(c.values()), len(c)
    for i, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(tok[i]), sum(c[w] > 0 for w in tok[i]), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in tok[i]))


def test_op4_states_are_distributions_and_help(spark, monkeypatch):
    monkeypatch.setattr(language_model, "P_CONTEXT", 0.01)
    monkeypatch.setattr(language_model, "P_JOINT", 0.002)
    r = random.Random(1)
    chain = {w: r.sample("abcdefgh", 2) for w in "abcdefgh"}
    rows = []
    for i in range(300):
        w = [r.choice("abcdefgh")]
        for _ in range(40):
            w.append(r.choice(chain[w[-1]]))
        rows.append((i, " ".join(w)))
    texts = spark.createDataFrame([(t,) for _, t in rows], "text string")
    tree, unigrams = language_model.train(texts)
    assert len(tree.contexts[0]) and len(tree.symbols) == 9
    every = np.arange(9)
    unknown = 1 / tree.z  # one unseen word holds the rest
    for level, names in enumerate(tree.contexts):
        for name in names:
            p = tree.prob(level, np.full(9, name), every)
            back = 1.0
            for lower in range(level, -1, -1):
                at = language_model._find(tree.contexts[lower], np.array([name & 0xFFFFFFFF if lower < level else name]))[0]
                back *= 10 ** tree.backoff[lower][at] if at >= 0 else 1.0
            assert p.sum() + back * unknown == pytest.approx(1, abs=1e-9)
    got = language_model.score(table(spark, rows), tree, unigrams, ["doc_id"]).collect()
    assert all(x.score > x.base_score + 5 for x in got)


def test_op4_repeated_phrases_are_states_at_any_share(spark, monkeypatch):
    """The shares decide only what is broadcast: phrases far below them are states; scores against brute force."""
    monkeypatch.setattr(language_model, "P_CONTEXT", 0.01)
    monkeypatch.setattr(language_model, "P_JOINT", 0.001)
    r = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(r.choices(words, k=100))) for i in range(600)]
    for i in range(20):
        rows[i] = (i, rows[i][1] + " zig zag " + ("left zug end" if i % 2 else "right zug stop"))
    texts = [t.encode().split() + [b""] for _, t in rows]
    tree, table_ = language_model.train(spark.createDataFrame([(t,) for _, t in rows], "text string"))
    got = {x.doc_id: x for x in language_model.score(table(spark, rows), tree, table_, ["doc_id"]).collect()}
    follow = collections.defaultdict(collections.Counter)
    for t in texts:
        for d in range(5):
            for i in range(len(t) - d):
                follow[tuple(t[i : i + d])][t[i + d]] += 1
    count = {c: sum(f.values()) for c, f in follow.items()}
    n, v = count[()], len(follow[()])

    def candidate(c):
        return not c or (count[c] >= 8 and candidate(c[1:]) and (len(c) == 1 or grows(c[1:])))

    def grows(c):
        return len(follow[c]) > 1 and (len(c) == 1 or diverges(c) or diverges(c[1:]))

    def left(c):
        return 1 - sum(x - 0.5 for x in follow[c].values() if x >= 2) / count[c]

    def p(c, w):
        if not c:
            return (follow[c][w] + 1) / (n + v + 1)
        return (max(follow[c][w] - 0.5, 0) / count[c] if follow[c][w] >= 2 else 0) + left(c) * p(c[1:], w)

    def diverges(c):
        stored = [w for w, x in follow[c].items() if x >= 2]
        gain = sum(p(c, w) * np.log(p(c, w) / p(c[1:], w)) for w in stored)
        return gain + left(c) * (1 - sum(p(c[1:], w) for w in stored)) * np.log(left(c)) >= 0.02

    states = {()}
    for c in [c for c in count if c and len(c) < 4 and candidate(c) and diverges(c)]:
        states |= {c[i:] for i in range(len(c) + 1)}
    assert (b"left", b"zug") in states
    for i in [*range(20), 100, 599]:
        t = texts[i]
        want = sum(np.log10(p(max((tuple(t[j - d : j]) for d in range(min(j, 3) + 1) if tuple(t[j - d : j]) in states), key=len), w)) for j, w in enumerate(t))
        assert got[i].score == pytest.approx(want, abs=1e-6)
    assert all(got[i].score > got[i].base_score + 10 for i in range(20))


def test_op4_tokens_are_lower_cased_words():
    import pyarrow as pa

    texts = ["The  cat\x0bTHE\tÉ é\x1c x\u3000y", None, "", " ", "ab ba the", "x" * 3000, "é cat"]
    words = [w for t in texts for w in [*(t or "").encode().lower().split(), b""]]
    got = list(language_model._tokens(pa.array(texts)))
    hashes = np.concatenate([x for x, _ in got]).tolist()
    assert [len((t or "").encode().split()) + 1 for t in texts] == np.concatenate([n for _, n in got]).tolist()
    assert len(hashes) == len(words) and len(set(zip(words, hashes, strict=True))) == len(set(words)) == len(set(hashes))


def test_op4_cut_texts_score_alike_and_no_tables_stay(spark, tmp_path, monkeypatch):
    """Deep levels read parts of the texts, cut again when a level needs more words; scoring writes neither texts' keys nor leaves the table."""
    from spanforge.llm import common

    r = random.Random(8)
    phrase = [f"p{i}" for i in range(4)]
    rows = [(i, " ".join([r.choice("abc"), *(r.choice([w, w, w + "x"]) for w in phrase), r.choice("de")])) for i in range(150)]
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    out = []
    for start, words in ((99, 16), (2, 3)):
        monkeypatch.setattr(language_model, "CUT_FROM", start)
        monkeypatch.setattr(language_model, "KEPT_WORDS", words)
        tree, held = language_model.train(spark.createDataFrame([(t,) for _, t in rows], "text string"))
        assert tree.depth > 3
        out.append({x.doc_id: x.score for x in language_model.score(table(spark, rows), tree, held, ["doc_id"]).collect()})
    assert out[0] == pytest.approx(out[1], abs=1e-9)
    assert {x.name.rsplit("_", 1)[0] for x in tmp_path.iterdir()} == {"spanforge_lm_rows"}


def test_op4_answers_come_home_packed(spark, tmp_path, monkeypatch):
    """What a task answers takes a row for each home (texts that ask together), not one for each text and task."""
    from spanforge.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    monkeypatch.setattr(language_model, "P_JOINT", 0.01)
    r = random.Random(9)
    rows = [(i, " ".join(f"w{r.randrange(900)}" for _ in range(60))) for i in range(400)]
    tree, held = language_model.train(spark.createDataFrame([(t,) for _, t in rows], "text string"))
    got = language_model.score(table(spark, rows).repartition(2), tree, held, ["doc_id"])
    assert got.count() == 400
    told = sum(spark.read.parquet(str(x)).count() for x in tmp_path.iterdir() if x.name.startswith("spanforge_lm_rows"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert told <= 400 + 2 * language_model.ROUNDS * tasks


def test_op4_index_and_order():
    r = np.random.default_rng(0)
    for keys in (np.zeros(0, np.uint64), np.array([7], np.uint64), r.permutation(np.unique(r.integers(0, 2**64, 3000, np.uint64))), np.uint64(5 << 60) + r.permutation(2000).astype(np.uint64)):
        assert (keys[language_model._order(keys)] == np.sort(keys)).all()
        asked = np.concatenate([keys, keys + np.uint64(1 << 40), np.array([0, 2**64 - 1], np.uint64)])
        place = {k: i for i, k in enumerate(keys.tolist())}
        assert language_model.Index(keys).find(asked).tolist() == [place.get(k, -1) for k in asked.tolist()]


def test_op4_empty(odd, nothing):
    assert language_model.language_model(nothing).count() == 0
    got = language_model.language_model(odd).collect()
    assert len(got) == 6 and all(r.n_tokens >= 1 for r in got)


# packing


def test_op5(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(docs, with_ids=True).collect()
    by, seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
        seq[p.sequence_id].append(p)
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids)) and p.length * 4 == len(p.ids)
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        parts = sorted(by[i], key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1]) and all(p.doc_tokens == len(ids) for p in parts)
        assert b"".join(bytes(p.ids) for p in parts) == np.array(ids, "<u4").tobytes()
    for parts in seq.values():
        parts.sort(key=lambda p: p.offset)
        n = sum(p.length for p in parts)
        assert [p.offset for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1])
        assert n <= 4096 and len(parts) <= 128 and (n & (n - 1)) == 0


def test_packer_holds_every_limit():
    r = random.Random(2)
    pk = packing.Packer(tokens=100, segments=4, loss=60, pool=16)
    items = [(i, r.choice([1, 3, 20, 90, 250]), r.choice([1, 10])) for i in range(300)]
    out = [p for i, n, q in items for p in pk.add(i, n, q)] + list(pk.flush())
    seq, done = collections.defaultdict(list), collections.Counter()
    prompt = {i: q for i, _, q in items}
    for i, a, b, s, _ in out:
        seq[s].append((i, a, b))
        done[i] += b - a
    assert done == {i: n for i, n, _ in items}
    for parts in seq.values():
        assert sum(b - a for _, a, b in parts) <= 100 and len(parts) <= 4 and sum(max(0, b - max(a, prompt[i])) for i, a, b in parts) <= 60


def test_word_ids_equal_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    w = packing.word_ids(path)
    for x in ["", "  a  b", "İstanbul ǅ ΑΣ ΑΣ.", "é ́x a b \x1c\x01 z \x01", "don't I'LL 3.14 <|endoftext|> x", "日本 語テ スト　x", "A\tB\x0bC\x0cD\r\nE"]:
        assert packing.tokenize([x], path)[0] == np.array([*w.tokenizer.encode(x, add_special_tokens=False).ids, 2], "<u4").tobytes()


# mixing


def test_op6(docs, rows):
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    size = {i: len((t or "").encode().split()) for i, t in rows}
    source = {i: None if i % 10 == 9 else f"src{i % 3}" for i, _ in rows}
    total = sum(size.values())
    per = collections.Counter()
    for i in size:
        per[source[i]] += size[i]
    names = sorted((s for s in per if s is not None)) + [None]
    weight = dict(zip(names, [5, 2, 1, 5, 2, 1], strict=False))
    target, open_, left = {}, set(names), float(total)
    while True:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 3 * per[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * per[s]
            left -= target[s]
            open_.remove(s)
    target |= {s: weight[s] * level for s in open_}
    taken = collections.Counter()
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], per[source[r.doc_id]]) and r.target == pytest.approx(target[r.source])
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(size.values()) if s == source[20] else abs(taken[s] - target[s]) <= 130


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(4)
    size = rng.integers(0, 400, 500).astype(float)
    size[:40] = 0
    p = np.full(500, 0.37)
    q = mixing.flight(p, np.column_stack([size, np.ones(500)]), np.random.default_rng(1))
    assert ((q > 0) & (q < 1)).sum() <= 2 and q.sum() == pytest.approx(p.sum()) and q @ size == pytest.approx(p @ size)
    mean = np.mean([mixing.flight(p[:30], np.column_stack([size[30:60], np.ones(30)]), np.random.default_rng(s)) for s in range(600)], axis=0)
    assert np.abs(mean - 0.37).max() < 0.09


def test_op6_odd(odd, nothing):
    assert mixing.mix(odd).count() == 6 and mixing.mix(nothing).count() == 0


# repeats


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = [True] * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_op8(docs, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect()}
    want = brute_repeats(rows, 100)
    assert got == want and sum(v[1] > 0 for v in want.values()) > 20


def test_op8_runs_and_overlaps(spark):
    rows = [(1, "ab" * 300), (2, "x" + "ab" * 80 + "y"), (3, "é" * 120), (4, "q" * 99), (5, "q" * 99), (6, "q" * 100 + "é" * 60)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(table(spark, rows)).collect()}
    assert got == brute_repeats(rows, 100)


def test_op8_odd(odd, nothing):
    assert all(r.n_removed == 0 for r in repeats.remove_repeats(odd).collect()) and repeats.remove_repeats(odd).count() == 6
    assert repeats.remove_repeats(nothing).count() == 0


# fingerprints


def test_op9(docs, rows):
    got = {r.doc_id: r for r in fingerprint.fingerprint_documents(docs).collect()}
    text = {i: t or "" for i, t in rows}
    ids = sorted(text, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    count = lambda t: collections.Counter(t.lower().split())

    def jaccard(a, b):
        top = sum(max(a[k], b[k]) for k in a | b)
        return sum(min(a[k], b[k]) for k in a | b) / top if top else 1.0

    errors = []
    for i, t in text.items():
        n, nxt = len(t), text[after[i]]
        edited = t[: n - n // 2] + nxt[: n // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.next_id) == (n, hashlib.sha256(edited.encode()).hexdigest(), after[i])
        errors += [r.near_edited - jaccard(count(t), count(edited)), r.near_next - jaccard(count(t), count(nxt))]
        assert (r.fingerprint == "") == (not t.split())
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.12
    same = collections.defaultdict(set)
    for i, t in text.items():
        same[t].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_op9_odd(odd, nothing):
    assert fingerprint.fingerprint_documents(nothing).count() == 0
    assert sorted(r.doc_id for r in fingerprint.fingerprint_documents(odd).collect()) == [1, 1, 2, 3]


def test_op9_successors_cross_runs_and_gaps(spark):
    ids = [0, 1, 127, 128, 5_000_000, 20_000_000_000, 20_000_000_001]
    got = {r.doc_id: r.next_id for r in fingerprint.successors(table(spark, [(i, str(i)) for i in ids])).collect()}
    order = sorted(ids, reverse=True)
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_op9_successors_of_sparse_ids(spark):
    r = random.Random(2)
    ids = [r.randrange(-(2**62), 2**62) for _ in range(500)]
    got = {x.doc_id: x.next_id for x in fingerprint.successors(table(spark, [(i, str(i)) for i in ids])).collect()}
    order = sorted(ids, reverse=True)
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_op9_likeness_comes_from_the_returned_fingerprints(docs):
    for x in fingerprint.fingerprint_documents(docs).collect():
        a, b = ([s[i : i + 4] for i in range(0, len(s), 4)] for s in (x.fingerprint, x.edited_fingerprint))
        want = 1.0 if not a and not b else 0.0 if not a or not b else sum(p == q for p, q in zip(a, b, strict=True)) / len(a)
        assert x.near_edited == want


def test_op1_refuses_impossible_sizes(spark):
    import struct

    bad = b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0) + b"\x2c" + b"\0" * 9
    small = b"GIF89a" + struct.pack("<HHBBB", 4, 4, 0x80, 0, 0) + b"\0" * 6 + b"\x2c" + struct.pack("<HHHHB", 0, 0, 65535, 65535, 0) + b"\x02\0\x3b"
    got = media.frames(spark.createDataFrame([("a", bytearray(bad)), ("b", bytearray(small))], "doc_id string, media binary")).collect()
    assert sorted(x.key for x in got) == ["a", "b"] and all(x.error for x in got)


def test_op1_texts_over_one_frame(spark):
    t = "".join(random.Random(1).choices("abcdé \n", k=150_000))
    rows = media.store(table(spark, [(None, t), (1, t), (1, t)])).collect()
    raw = t.encode()
    assert len(rows) == 3 and len({(x.payload_sha256, x.media_sha256, x.feature) for x in rows}) == 1
    assert rows[0].n_bytes == len(raw) and rows[0].payload_sha256 == hashlib.sha256(raw + b"\0" * (-len(raw) % 64)).hexdigest()
    assert rows[0].feature.startswith(f"frames={-(-rows[0].payload_bytes // 65536)};")


def test_op6_leftovers_fly_in_shards_again(spark):
    r = random.Random(6)
    rows = [(i if i % 9 else None, sentence(r, r.randrange(1, 30)), "en", "abc"[i % 3], 0) for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), shard_rows=6).collect()
    for s in "abc":
        mine = [x for x in got if x.source == s]
        assert abs(sum(x.taken for x in mine) - mine[0].target) <= 30 and all(x.copies <= 3 for x in mine)
    assert len(got) == 900


# lines


def brute_lines(rows, percent):
    k = line_dedup.SHINGLE
    at = []
    for i, t in rows:
        for n, x in enumerate([] if t is None else t.split("\n")):
            b = x.strip(" ").lower()
            if b:
                at.append(((i, n), frozenset(b[j : j + k] for j in range(max(len(b) - k, 0) + 1)), b))
    first = {}
    for place, s, b in sorted(at, key=lambda x: x[0]):
        first.setdefault(b, (place, s))
    nodes = list(first.values())
    links = [(p, q) for p, a in nodes for q, b in nodes if p < q and 100 * len(a & b) >= percent * len(a | b)]
    kept = set(brute_components([p for p, _ in nodes], links).values())
    return {place for place, _, _ in at} - kept, len(links)


def test_op10(docs, rows):
    want, links = brute_lines(rows, line_dedup.PERCENT)
    got = {r.doc_id: r for r in line_dedup.dedup(docs).collect()}
    removed = {(i, n) for i, r in got.items() for n in r.lines_removed}
    assert links and len(removed ^ want) <= 0.02 * len(want)
    for i, t in rows:
        keep = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in removed)
        assert got[i].text == keep and got[i].place == "x"


def test_op10_links_that_pass_no_first_line_are_found(spark):
    """Many template lines share band keys with pairs that are alike: every pair that shares a key is found."""
    r = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz "
    some = lambda n: "".join(r.choices(letters, k=n)).replace(" ", "_")
    head = some(160)
    lines = [head + some(30) for _ in range(60)]
    for _ in range(60):
        x = head + some(30)
        lines += [x, x[:-14] + some(14)]
    rows = list(enumerate(lines))
    want, links = brute_lines(rows, line_dedup.PERCENT)
    got = {(x.doc_id, n) for x in line_dedup.dedup(table(spark, rows)).collect() for n in x.lines_removed}
    assert links >= 60 and got <= want and len(want - got) <= 2


def test_op10_near_misses_hide_no_link(spark):
    """Lines of one template that are 0.76 alike, each with a copy at 0.97."""
    r = random.Random(31)
    some = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz_", k=n))
    head, lines = some(260), []
    for _ in range(150):
        x = head + some(38)
        lines += [x, x[:-4] + some(4)]
    rows = [(i, x) for i, x in enumerate(lines)]
    want, links = brute_lines(rows, line_dedup.PERCENT)
    got = {(x.doc_id, n) for x in line_dedup.dedup(table(spark, rows)).collect() for n in x.lines_removed}
    assert links >= 150 and got <= want and len(want - got) <= 0.02 * len(want)


def test_op10_repeated_ids_and_clashing_names(spark):
    line = "a line that is long enough to be compared with others, said twice"
    rows = table(spark, [(1, f"{line}\nfirst"), (1, f"{line}\nsecond"), (1, f"{line}\nsecond"), (2, f"third\n{line}")])
    rows = rows.withColumns({c: F.lit(7) for c in ("removed", "n_lines", "body", "h1", "component", "_row")})
    got = sorted((x.doc_id, x.text, x.removed, x.n_lines) for x in line_dedup.dedup(rows).collect())
    assert got == [(1, f"{line}\nfirst", 7, 7), (1, f"{line}\nsecond", 7, 7), (1, f"{line}\nsecond", 7, 7), (2, "third", 7, 7)]


def test_op10_equal_short_lines_go(spark, tmp_path):
    rows = [(1, "All rights reserved.\nok\n\n版权所有"), (2, "all rights reserved. \n\nno"), (3, "版权所有\nok\nokk")]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: x.removed_lines for x in line_dedup.op10_line_minhash(spark, str(tmp_path)).collect()}
    assert got == {1: "", 2: "0", 3: "0,1"}


def test_op10_odd(odd, nothing):
    assert line_dedup.dedup(odd).count() == 6 and line_dedup.dedup(nothing).count() == 0
    assert all(r.text is not None for r in line_dedup.dedup(odd).filter("doc_id is null and n_chars > 0").collect())
