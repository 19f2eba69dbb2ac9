"""Small fixtures: nulls, empties, repeats, ties, hot groups, clashing extra columns, empty tables."""

from __future__ import annotations

import os
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafmill.llm import bpe, decontaminate, embeddup, langid, linededup, minhash, quotes, sharding, suffixdedup, toxicity
from tests.llm import brute

DOCS = "doc_id long, text string, _key string, row string, d int"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    shared = "\n".join(words(rng, 12) for _ in range(4))
    passage = words(rng, 60)
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, "short"), (5, "Ünïcode ÉÀ \U0001f600 straße"), (6, "x" * 3000), (7, "ab " * 900)]
    for i in range(8, 40):
        rows.append((i, f"{words(rng, 30)}\n{shared if i % 3 else shared.upper()}\n{words(rng, 40)} {passage if i % 4 == 0 else ''} {words(rng, 20)}"))
    base = words(rng, 300)
    for i in range(40, 70):  # near copies
        t = base.split()
        for _ in range(i % 5):
            t[rng.randrange(len(t))] = f"edit{i}{rng.random()}"
        rows.append((i, " ".join(t)))
    rows += [(i, "the same short text of seven words") for i in range(70, 80)]
    rows.append((100, words(rng, 9000)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash", 7) for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return frame(spark, corpus)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_lines(spark, docs, corpus, none):
    want = brute.line_dedup(corpus)
    got = {r["row"]["doc_id"]: (r["_n_lines"], r["_n_dropped"], bytes(r["_kept"]).decode()) for r in linededup.dedup_lines(docs).collect()}
    assert got == {d: (w[0], w[1], w[3]) for d, w in want.items()}
    assert sum(w[1] for w in want.values()) > 50
    assert linededup.dedup_lines(none).count() == 0


def test_hot_line_over_many_partitions(spark):
    rows = [(i, f"this very line is everywhere\nown line number {i} of this text") for i in range(500)] + [(None, "this very line is everywhere")]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {r["row"]["doc_id"]: r["_n_dropped"] for r in linededup.dedup_lines(frame(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {i: int(i != 499) for i in range(500)} | {None: 1}


def test_repeated_ids_count_once(spark):
    rows = [(1, "a line of some twenty characters"), (1, "a line of some twenty characters"), (2, "A line of some twenty characters ")]
    assert [r["_n_dropped"] for r in linededup.dedup_lines(frame(spark, rows)).collect()] == [0, 0, 0]


def test_decontamination(spark, docs, corpus, none):
    rng = random.Random(9)
    long = dict(corpus)[12].split()
    items = [(1, " ".join(long[40:70])), (2, "short same TEXT of seven".lower()), (3, None), (4, ""), (5, words(rng, 20)), (6, "seven"), (7, " ".join(long[40:70]).upper()), (None, "straße")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.decontaminate(corpus, [("" if i is None else i, t) for i, t in items])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"]), brute.sha(",".join(r["items"]).encode())) for r in decontaminate.find(docs, bench).collect()}
    assert got == {d: w[:4] for d, w in want.items()}
    kept = {r["doc_id"] for r in decontaminate.keep_clean(docs, bench).collect()}
    assert kept == {d for d, w in want.items() if not w[4]}
    assert decontaminate.find(none, bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_an_item_in_a_long_document_leaks(spark):
    """An item of 20 words in 1,500, one cut by a line break, one of which a third stands there."""
    rng = random.Random(21)
    items = [(i, words(rng, 20, 50_000)) for i in range(4)]
    half = items[2][1].split()
    docs = [
        (1, f"{words(rng, 700)} {items[0][1]} {words(rng, 780)}"),
        (2, f"{words(rng, 700)} {items[1][1].replace(' ', chr(10), 3)} {words(rng, 700)}"),
        (3, f"{words(rng, 700)} {' '.join(half[:14])} {words(rng, 700)}"),
        (4, words(rng, 900)),
        (5, f"{words(rng, 900)} yes no"),
        (6, None),
    ]
    bench = spark.createDataFrame([*items, (9, "yes no"), (10, None)], "item_id long, text string")
    kept = decontaminate.keep_clean(frame(spark, docs), bench, decontaminate.leaked())
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]
    assert kept.columns == frame(spark, docs).columns
    leak = {r["doc_id"]: r["leak"] for r in decontaminate.find(frame(spark, docs), bench).collect()}
    assert leak == {1: 1.0, 2: 1.0, 3: 2 / 8, 4: 0.0, 5: 0.0, 6: 0.0}


def test_a_passage_of_many_items_in_many_documents(spark):
    """Equal sets of windows are looked up once, whatever the number of documents."""
    rng = random.Random(22)
    passage = words(rng, 30)
    docs = [(i, f"{words(rng, 20, 10**9)} {passage} {words(rng, 20, 10**9)}") for i in range(300)]
    items = [(i, f"{words(rng, 9)} {passage}" if i % 2 else words(rng, 30)) for i in range(100)]
    out = decontaminate.find(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["n_hit"], len(r["items"])) for r in out} == {(30, 50)} and len(out) == 300


@pytest.mark.parametrize("group", [16_384, 3])
def test_repeats(spark, docs, corpus, none, group):
    rows = [*corpus, (200, corpus[-1][1]), (201, "In. " * 300)]
    want = brute.long_repeats(rows)
    out = suffixdedup.remove_repeats(frame(spark, rows), group=group)
    got = {r["row"]["doc_id"]: (len(r["_kept"]) + r["_n_removed"], r["_n_removed"], r["_n_spans"], brute.sha(bytes(r["_kept"]))) for r in out.collect()}
    assert got == {d: w for (d, _), w in zip(rows, want, strict=True)}
    assert suffixdedup.remove_repeats(none).count() == 0


def test_equal_rows_remove_each_other(spark):
    text = "".join(random.Random(3).choices("abcdefgh ", k=500))
    out = suffixdedup.remove_repeats(frame(spark, [(1, text), (1, text)])).collect()
    assert [r["_n_removed"] for r in out] == [500, 500]


def test_family_levels_merge(spark):
    family = suffixdedup.SuffixFamily()
    rng = random.Random(1)
    for i in range(4):
        family.add(spark.createDataFrame([(words(rng, 200).encode(),)], "text binary"))
        assert [rank for rank, _ in family.levels] == {0: [0], 1: [1], 2: [1, 0], 3: [2]}[i]


def test_family_levels_merge_in_one_step(spark, monkeypatch):
    """Runs and matches of four batches are eight tables; two merges make one each, and nothing else is left."""
    made, real = [], suffixdedup.C.cut
    monkeypatch.setattr(suffixdedup.C, "cut", lambda df: made.append(real(df)) or made[-1])
    family = suffixdedup.SuffixFamily()
    rng = random.Random(2)
    texts = [words(rng, 200) for _ in range(3)]
    for t in (*texts, texts[0]):
        family.add(spark.createDataFrame([(t.encode(),)], "text binary"))
    assert len(made) == 10
    assert [os.path.exists(x._cut_at.removeprefix("file:")) for x in made].count(True) == 2
    entries = family.repeated().collect()
    assert entries and {r["n"] for r in entries} == {2}


@pytest.mark.parametrize("parts", [1, 2])
def test_many_classes_settle_in_little_memory(parts):
    """4,096 classes of one gram; each 64th holds the same 210 bytes between bytes of its own."""
    rng = np.random.default_rng(8)
    bodies = [rng.integers(97, 123, 290, dtype=np.uint8).tobytes() for _ in range(4096)]
    k, shared, common = len(bodies), range(0, len(bodies), 64), bytes(range(210))
    for i in shared:
        own = bytes([128 + i // 64])
        bodies[i] = bodies[i][:59] + own + common + own + bodies[i][271:]
    table = pa.table({"fp": [5] * k, "part": [0] * k, "parts": [parts] * k, "ctx": range(k), "n": [1] * k, "body": pa.array(bodies, pa.binary())})
    tracemalloc.start()
    out = [r for b in suffixdedup._settle(200)(iter(table.to_batches())) for r in zip(*(b.column(c).to_pylist() for c in ("kind", "ctx", "at", "to")), strict=True)]
    peak = tracemalloc.get_traced_memory()[1] if parts == 1 else 0
    tracemalloc.stop()
    assert sorted(r[1:] for r in out if r[0] == 0) == [(i, 60, 70) for i in shared]
    assert sum(r[0] == 1 for r in out) == (parts - 1) * (91 * k - 11 * len(shared)) and sum(r[0] == 2 for r in out) == (parts - 1) * 11
    assert peak < 35 * sum(map(len, bodies))


def test_near_duplicates(spark, docs, corpus, none):
    want = brute.near_duplicates(corpus)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["doc_id"] == r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == want
    kept = [r["doc_id"] for r in minhash.keep_first(docs).collect()]
    assert sorted(kept) == sorted(d for d, w in want.items() if w[2])
    twice = minhash.keep_first(docs.unionByName(docs))
    empty = [d for d, w in want.items() if not w[0]]
    assert sorted(r["doc_id"] for r in twice.collect()) == sorted([*kept, *empty])
    assert minhash.near_duplicates(none).count() == 0 and minhash.keep_first(none).count() == 0


def test_unlinked_lookalikes_stay_apart(spark):
    """A large bucket whose members mostly aren't linked is compared whole, in blocks."""
    rng = random.Random(8)
    base = words(rng, 200, 10_000).split()
    rows = []
    for i in range(120):
        t = list(base)
        for k in range(4 + i % 3):
            t[rng.randrange(200)] = f"e{i}x{k}"
        rows.append((i, " ".join(t)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {d: w[1] for d, w in brute.near_duplicates(rows).items()}


def test_long_sets_leave_blocks_empty(spark, monkeypatch):
    """Sets of more shingles than a block holds: more blocks than sets, most of them empty."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 100)
    rng = random.Random(13)
    base = words(rng, 200, 10_000).split()
    rows = []
    for i in range(12):
        t = list(base)
        for k in range(2 + i % 3):
            t[rng.randrange(200)] = f"e{i}x{k}"
        rows.append((i, " ".join(t)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {d: w[1] for d, w in brute.near_duplicates(rows).items()} and len(set(got.values())) > 1


def test_block_without_rows_has_no_links():
    sets, sig = [np.arange(3, dtype=np.uint64).tobytes()], [[0] * 2 * minhash.PARTS]
    for block in (0, 1):
        t = pa.table({"i": [0], "x": [0], "y": [1], "node": [7], "root": [7], "n": [3], "block": [block], "sig": sig, "set": sets})
        assert minhash._across(85)(t).num_rows == 0


def test_overlaps_agree():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, 120).astype(np.uint64)) for _ in range(30)]
    p, q = np.triu_indices(30, 1)
    assert (minhash.overlaps(sets, p, q) == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(p, q, strict=True)]).all()


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(150)]
    rows += [(200 + i, (np.array(rows[i][1]) + rng.normal(size=16) * 0.08).tolist()) for i in range(40)]
    rows += [(300 + i, rows[7][1]) for i in range(30)] + [(400, (np.array(rows[7][1]) * 3).tolist())]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [None] * 16), (504, [float("inf")] + [1.0] * 15), (505, []), (506, [1.0, 2.0]), (507, [2.0, 4.0])]
    frame_ = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, node string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["vec_id"] == r["component_id"]) for r in embeddup.link_vectors(frame_, recall=0.999999).collect()}
    assert got == brute.cosine_links(rows)
    assert embeddup.link_vectors(frame_.limit(0)).count() == 0


def test_embeddings_at_the_usual_recall(spark):
    """300 pairs at a cosine just over 0.9, among vectors that fill the buckets."""
    rng = np.random.default_rng(12)
    a = rng.normal(size=(300, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=(300, 32))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(0.9005, 0.93, (300, 1))
    b = c * a + np.sqrt(1 - c * c) * side
    rest = rng.normal(size=(9000, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b, rest]))]
    got = {r["vec_id"]: r["n_links"] for r in embeddup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("n_links > 0").collect()}
    assert sum(got.get(i, 0) > 0 and got.get(300 + i, 0) > 0 for i in range(300)) >= 297


@pytest.fixture(scope="module")
def plain_bpe():
    """The library by itself, without this package."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize(("chunk", "overlap", "spread", "reach"), [(1 << 12, 1 << 8, 1 << 18, 1 << 11), (200, 50, 900, 80), (64, 4, 300, 4), (7, 2, 64, 3)])
def test_bpe_round_trip(spark, corpus, none, plain_bpe, chunk, overlap, spread, reach):
    rows = [*corpus, (101, "  " * 400 + "\n\n a"), (102, "it's  \n\n\n b " * 90), (101, "again"), (None, "no id"), (103, "<|endoftext|> 12345    x"), (104, "y" * 700 + " z " + " " * 900 + "ok " * 200)]
    out = bpe.decode_documents(bpe.encode_documents(frame(spark, rows), None, chunk, overlap, spread, reach)).collect()
    want = sorted((str(d), np.asarray(plain_bpe.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t in rows)
    assert sorted((str(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in out) == want
    assert bpe.decode_documents(bpe.encode_documents(none)).count() == 0


def test_bpe_pieces_meet(plain_bpe):
    rng = random.Random(31)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "é", " ", "  ", "\n", "'s", "1", "!", "x" * 30, " " * 30, "\u3000"]) for _ in range(rng.randrange(0, 120)))
        cut = list(bpe.pieces(text, rng.randrange(1, 40), rng.randrange(0, 12)))
        assert "".join(cut) == text
        assert [i for x in cut for i in plain_bpe.encode_ordinary(x)] == plain_bpe.encode_ordinary(text)


def test_sharding(spark, docs, corpus, none):
    rows = corpus * 3 + [(1000 + i, "a hot text that a third of all rows have") for i in range(150)]
    out = sharding.assign(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    slots, sizes, groups = {}, {}, {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        groups.setdefault(r["group"], set()).add(r["shard"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(16))
    total, largest = sum(sizes.values()), max(r["size"] for r in out)
    assert sum(r["size"] for r in out) == total and max(sizes.values()) <= total / 16 + largest
    share = {}
    for r in out:
        n = share.setdefault(r["group"], [0, 0, 0])
        n[0], n[1], n[2] = n[0] + r["size"], n[1] + r["tokens"], n[2] + 1
    sums = [sum(n[k] for n in share.values()) for k in range(3)]
    fair = {g for g, n in share.items() if all(16 * x <= s for x, s in zip(n, sums, strict=True))}
    assert all(len(groups[g]) == 1 for g in fair) and len(fair) > 50
    assert any(len(s) > 1 for s in groups.values())
    text = dict(corpus)
    assert all(r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) for r in out if r["doc_id"] in text)
    assert sharding.assign(none).count() == 0


def test_equal_rows_spread(spark):
    """One row, id and all, many times: a slot each, in all shards."""
    out = sharding.assign(frame(spark, [(1, "the very same row")] * 3000)).collect()
    at = {}
    for r in out:
        at.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(at) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in at.values())
    assert {r["tokens"] for r in out} == {4} and max(map(len, at.values())) < 1.3 * 3000 / 16


def test_tokens_of_scripts(spark):
    out = sharding.assign(frame(spark, [(1, "two\nwords"), (2, "東京 tower"), (3, None), (4, " \t ")])).collect()
    assert {r["doc_id"]: r["tokens"] for r in out} == {1: 2, 2: 4, 3: 1, 4: 4}


def test_place_is_balanced():
    rng = np.random.default_rng(3)
    v = np.column_stack([rng.lognormal(8, 1, 3000), rng.lognormal(6, 1, 3000), np.ones(3000)])
    where = sharding.level(v, sharding.place(v))
    load = np.bincount(where, v[:, 0], 16)
    assert load.max() / load.min() < 1.001
    assert np.bincount(where, v[:, 2], 16).max() < 1.1 * 3000 / 16


def test_place_agrees_with_plain_packing():
    """Against a loop over shards, one item at a time."""
    rng = np.random.default_rng(4)
    v = np.column_stack([rng.lognormal(5, 1, 200), rng.lognormal(3, 1, 200), np.ones(200)])
    unit = [v[:, k].sum() / 16 for k in range(3)]
    x = [[row[k] / unit[k] for k in range(3)] for row in v]
    free, want = [[1.0] * 3 for _ in range(16)], {}
    for i in sorted(range(200), key=lambda i: (-max(x[i]), i)):
        fit = [s for s in range(16) if all(f >= a - 1e-9 for f, a in zip(free[s], x[i], strict=True))]
        fit = fit or [s for s in range(16) if free[s][0] >= max(f[0] for f in free) - 1e-12]
        best = max(fit, key=lambda s: (round(sum(max(f, 0) * a for f, a in zip(free[s], x[i], strict=True)), 12), -s))
        want[i] = best
        free[best] = [f - a for f, a in zip(free[best], x[i], strict=True)]
    assert [want[i] for i in range(200)] == sharding.place(v).tolist()


def plain_language(net, text):
    """The network window by window, filter by filter, position by position."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    raw = bytearray()
    for c in text:
        low = c.lower() if c < "\u0100" and len(c.lower().encode()) == len(c.encode()) and c not in "ÿŸ" else c
        raw += (low if ord(c) > 127 or low.isalpha() else " ").encode()
    total, cache = np.zeros(len(net.langs)), {}
    for at in range(0, len(raw), langid.WINDOW):
        part = bytes(raw[at : at + langid.WINDOW])
        if part not in cache:
            e = net.embed[np.frombuffer(part.ljust(langid.WINDOW + langid.SPAN - 1, b"\0"), np.uint8)]
            acts = np.array([(e[i : i + langid.SPAN].ravel()[:, None] * net.filters).sum(axis=0) for i in range(langid.WINDOW)])
            z = np.maximum(acts.max(axis=0) + net.bias, 0) @ net.out + net.out_bias
            cache[part] = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        total += cache[part] * len(part)
    total /= len(raw)
    return net.langs[int(total.argmax())], float(total.max())


def test_language(spark, none):
    rng = random.Random(4)
    parts = {"aa": ["kalo", "miku", "tase"], "bb": ["thorn", "shwik", "gryst"], "cc": ["écra", "oué", "çente"]}
    rows = [(i, " ".join(rng.choices(parts[lang], k=rng.randrange(5, 200))), lang) for i, lang in enumerate(rng.choices(list(parts), k=400))]
    net = langid.fit(spark.createDataFrame(rows[:300], "doc_id long, text string, lang string"))
    tail = [(i, t) for i, t, _ in rows[300:]] + [(900, None), (901, ""), (902, "12 34 !!"), (903, "kalo")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(frame(spark, tail), net).collect()}
    assert sum(got[i][0] == lang for i, _, lang in rows[300:]) >= 98
    assert all(got[i] == ("und", 0.0) for i in (900, 901, 902)) and all(0 <= s <= 1 for _, s in got.values())
    assert langid.predict(none, net).count() == 0
    assert langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string")) is None
    assert {r["lang_pred"] for r in langid.predict(frame(spark, tail), None).collect()} == {"und"}
    tail += [(905, "kalo miku tase " * 60_000), (906, "kalo"), (907, "thorn écra " * 9)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(frame(spark, tail), net).collect()}
    for i, t in tail:
        name, score = plain_language(net, t)
        assert got[i][0] == name and got[i][1] == pytest.approx(score, abs=1e-5)
    assert got[903] == got[906]


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(6)
    k = langid.FILTERS * len(langid.WIDTHS)
    draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    net = langid.Network(["aa", "bb", "cc"], draw(0.5, 256, langid.EMBED), draw(0.3, langid.SPAN * langid.EMBED, k), draw(0.1, k), draw(0.2, k, 3), draw(0.1, 3))
    rows = rng.integers(97, 123, (130, langid.WINDOW + langid.SPAN - 1)).astype(np.uint8)
    alone = np.concatenate([net.probabilities(rows[i : i + 1]) for i in range(len(rows))])
    for n in (2, 3, 17, 64, 65, 130):
        assert np.array_equal(net.probabilities(rows[:n]), alone[:n])
        assert np.array_equal(net.probabilities(rows[-n:]), alone[-n:])


def plain_hits(lexicon, text):
    """Whole words of the lexicon, none inside an exception phrase, by regular expressions."""
    import re

    t = toxicity.fold(text)
    whole = lambda x: list(re.finditer(rf"(?<![^\W_])(?={re.escape(x)}(?![^\W_]))", t))
    spared = [(m.start(), m.start() + len(p)) for p in map(toxicity.fold, lexicon.exceptions) for m in whole(p)]
    hits = [(m.start(), m.start() + len(w)) for w in lexicon.weights for m in whole(w)]
    return sum(not any(a <= i and j <= b for a, b in spared) for i, j in hits)


def test_long_texts_of_phrases_take_linear_time():
    import time

    lexicon = toxicity.Lexicon({"ciown": 3.0, "idiot": 4.0}, (-3.0, 1.0, 1.0))
    lexicon.hits("warm up")
    took = []
    for n in (20_000, 80_000):
        begun = time.process_time()
        assert lexicon.hits("clown fish idiot " * n)[1] == n
        took.append(time.process_time() - begun)
    assert took[1] < 12 * took[0]


def test_exceptions_are_learned(spark):
    """Clean texts that hold a lexicon word in one phrase only teach that phrase."""
    rng = random.Random(17)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 3 == 0
        more = "idiot" if bad else "idiot board" if i % 100 == 1 else ""
        rows.append((i, f"{words(rng, 20)} {more} {words(rng, 20)}"))
        labels.append((i, int(bad)))
    lexicon = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(lexicon.weights) == {"idiot"} and "idiot board" in lexicon.exceptions
    assert [toxicity.Lexicon.hits(lexicon, t)[1] for t in ("an idiot board", "an idiot", "idiot boards")] == [0, 1, 1]


def test_toxicity(spark, none):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        t = words(rng, rng.randrange(10, 200)).split()
        for _ in range(2 * bad):
            t.insert(rng.randrange(len(t)), rng.choice(["idiot", "moron", "clown"]))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    lexicon = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(lexicon.weights) == {toxicity.fold(w) for w in ("idiot", "moron", "clown")}
    tests = {700: "you 1D10T", 701: "іdіоt here", 702: "a clown fish swims", 703: None, 704: "", 705: "idiotic idea", 706: "Ｍｏｒｏｎ", 707: "what a CLOWN!!"}
    got = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.score(frame(spark, list(tests.items())), lexicon).collect()}
    assert got == {700: True, 701: True, 702: False, 703: False, 704: False, 705: False, 706: True, 707: True}
    assert [r["doc_id"] for r in toxicity.keep_clean(frame(spark, list(tests.items())), lexicon).orderBy("doc_id").collect()] == [702, 703, 704, 705]
    hot = " ".join(rng.choice(["idiot", "moron", "w1", "sore", "loser", "clown", "fish", "1diot", "clown fish"]) for _ in range(4000))
    mixed = [(800 + i, " ".join(rng.choice(["idiot", "clown", "fish", "clown fish", "w2", "idiots", "mor0n", "x-moron"]) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    got = {r["doc_id"]: r["hits"] for r in toxicity.score(frame(spark, [(799, hot), *mixed]), lexicon).collect()}
    assert got == {i: plain_hits(lexicon, t) for i, t in [(799, hot), *mixed]}
    assert toxicity.score(none, lexicon).count() == 0 and toxicity.keep_clean(none, lexicon).count() == 0
    blank = toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(frame(spark, rows[:3]), blank).where("score > 0.5").count() == 0


def test_toxic_words_of_a_small_language(spark):
    """A word in 8 of 600 toxic texts and no clean one counts; one in 4, as chance has it, doesn't."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(2400):
        bad = i < 600
        rows.append((i, f"{words(rng, 30)} {'' if not bad else 'bocoes' if i < 8 else 'idiot'} {'maybe' if 100 <= i < 104 else ''}"))
        labels.append((i, int(bad)))
    lexicon = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(lexicon.weights) == {"bocoes", "idiot"}
    assert toxicity.score(frame(spark, [(1, "w1 bocoes w2")]), lexicon).where("score >= 0.5").count() == 1


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I bake bread at home?\n\nAlso, which flour is the best one?"),
        (1, 1, "assistant", "> How do I bake bread at home?\nMix and wait."),
        (1, 2, "user", "> Also, which   FLOUR is the best one?\n\nStill waiting here on it"),
        (1, 3, "assistant", ">> How do I bake bread at home?\n> Mix and wait.\nok then let us see"),
        (2, 0, "user", "> Still waiting here on it\nMe too, what a pity"),
        (2, 1, "assistant", "noted, thank you so much"),
        (3, 0, "user", "> noted, thank you so much\nwelcome"),
        (3, 1, "user", None),
        (None, None, None, "x"),
        (4, 0, "user", "plain"),
        (4, 700, "assistant", "plain reply"),
        (4, 1400, "user", "> something that nobody ever said\nlast"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, mid string")
    got = {(r["conv_id"], r["turn"]): (r["text"], r["n_quoted"], r["parent_conv_id"], r["parent_turn"], r["thread_conv_id"], r["thread_turn"], r["depth"]) for r in quotes.build(df).collect()}
    assert got == {
        (1, 0): (rows[0][3], 0, None, None, 1, 0, 0),
        (1, 1): ("Mix and wait.", 1, 1, 0, 1, 0, 1),
        (1, 2): ("\nStill waiting here on it", 1, 1, 0, 1, 0, 1),
        (1, 3): ("ok then let us see", 2, 1, 1, 1, 0, 2),
        (2, 0): ("Me too, what a pity", 1, 1, 2, 1, 0, 2),
        (2, 1): ("noted, thank you so much", 0, 2, 0, 1, 0, 3),
        (3, 0): ("welcome", 1, 2, 1, 1, 0, 4),
        (3, 1): ("", 0, 3, 0, 1, 0, 5),
        (None, None): ("x", 0, None, None, None, -1, 0),
        (4, 0): ("plain", 0, None, None, 4, 0, 0),
        (4, 700): ("plain reply", 0, 4, 0, 4, 0, 1),
        (4, 1400): ("last", 1, 4, 700, 4, 0, 2),
    }
    assert quotes.build(df.limit(0)).count() == 0


def test_quotes_by_lines(spark):
    """Interleaved replies, one line of a paragraph, short quotes of one's own conversation."""
    rows = [
        (1, 0, "user", "Line one of it\nLine two of it\nYes"),
        (1, 1, "assistant", "something else altogether"),
        (1, 2, "user", "> Line one of it\nanswer\n> Line two of it\nanother"),
        (1, 3, "user", "> something else altogether\n> that nobody said\nwell"),
        (1, 4, "user", "> Yes\nagreed then"),
        (1, 5, "user", ">> Yes\n> agreed then\nfine"),
        (2, 0, "user", "> Yes\nnot from there"),
        (2, 1, "user", "> line TWO  of it\nfrom there"),
    ]
    got = {(r["conv_id"], r["turn"]): (r["linked"], r["parent_conv_id"], r["parent_turn"]) for r in quotes.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {(1, 0): (False, None, None), (1, 1): (False, 1, 0), (1, 2): (True, 1, 0), (1, 3): (True, 1, 1), (1, 4): (True, 1, 0), (1, 5): (True, 1, 4), (2, 0): (False, None, None), (2, 1): (True, 1, 0)}


def test_quotes_of_null_ids_spread(spark):
    """Messages without ids are one conversation, dealt to many ranges; order and links hold."""
    rows = [(None, None, f"r{i:04d}", f"message number {i} of this talk") for i in range(400)] + [(5, 1, "user", "> message number 7 of this talk\nyes")]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = quotes.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(r["depth"] for r in out if r["conv_id"] is None) == list(range(400))
    assert [(r["linked"], r["parent_conv_id"], r["text"]) for r in out if r["conv_id"] == 5] == [(True, None, "yes")]


def test_operator_results_feed_the_pipeline(spark, tmp_path, corpus):
    import corpus_pipeline

    d = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in corpus], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, dict(corpus)[9].split("\n")[0])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    lines = [(i, w[3]) for i, w in brute.line_dedup(corpus).items()]
    near = brute.near_duplicates(lines)
    left = [(i, t) for i, t in lines if near[i][2]]
    bad = brute.decontaminate(left, [(1, dict(corpus)[9].split("\n")[0])])
    want = sorted((i, brute.sha(t.encode())) for i, t in left if not bad[i][4])
    assert sorted((r["doc_id"], r["text_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want


def test_pipeline_takes_odd_tables(spark, tmp_path, corpus, none):
    """Null labels, repeated rows, null ids and texts, ties, columns with clashing names, no rows."""
    import corpus_pipeline

    rng = random.Random(41)
    item, line = words(rng, 25, 10**6), "the very same long line that many hold"
    rows = [(i, f"{words(rng, 40, 10**6)}\n{line if i % 2 else words(rng, 9)}\n{words(rng, 30, 10**6)}") for i in range(12)]
    rows += [(20, f"{words(rng, 900, 10**6)} {item} {words(rng, 900, 10**6)}"), (20, rows[0][1]), (21, rows[2][1]), (None, words(rng, 20)), (22, None), (22, None), (23, ""), (0, rows[0][1]), (0, rows[0][1])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key string, row int, toxic string, item string, h long"
    docs = spark.createDataFrame([(i, t, None, None, len(t or ""), "a", 1, "b", "c", 5) for i, t in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (None, None), (1, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, None, None), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0 and empty.columns == docs.columns, name
    ids = [r["doc_id"] for r in kept.collect()]
    lines = {i: w[3] for i, w in brute.line_dedup([(0 if i is None else i, t) for i, t in rows]).items()}
    assert sorted(i for i in ids if i is not None) == [*range(12), 22, 22, 23] and ids.count(None) == 1 and lines[11].count(line) == 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(map(str, ids)) and all(4 * r["n_tokens"] == len(r["ids"]) for r in out)
    assert corpus_pipeline.encode(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline_drops_near_duplicates_at_80_percent(spark):
    import corpus_pipeline

    rng = random.Random(12)
    rows = []
    for i in range(0, 20, 2):  # pairs of similarity 176 / 216
        t = words(rng, 200, 100_000).split()
        rows.append((i, " ".join(t)))
        for k in (20, 70, 120, 170):
            t[k] = f"edit{k}"
        rows.append((i + 1, " ".join(t)))
    want = brute.near_duplicates(rows, 80)
    assert sum(w[2] for w in want.values()) == 10 and all(w[2] for w in brute.near_duplicates(rows, 85).values())
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [d for d, w in want.items() if w[2]]


def test_quotes_agree_with_sql(spark):
    import duckdb
    import pandas as pd

    rng = random.Random(11)
    rows, said = [], []
    for c in range(30):
        for t in range(rng.randrange(1, 9)):
            parts = [f"message {words(rng, 6)}" for _ in range(rng.randrange(1, 4))]
            for _ in range(rng.randrange(0, 3) if said else 0):
                parts.insert(rng.randrange(len(parts) + 1), rng.choice(["> ", ">> ", " >", "> > "]) + rng.choice(said))
            said += [p for p in parts if p[:1] == "m"]
            if rng.random() < 0.3:
                parts.insert(0, f"> {rng.choice(['ok', 'message w1'])}\n> {rng.choice(said)}")
            parts += rng.choice([[], ["ok"], ["message w1", "ok"]])
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["\n", "\n\n"]).join(parts)))
    got = quotes.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    want = con.sql(quotes.OP8_SQL)
    assert got.columns == want.columns
    a, b = ({(r[0], r[1]): tuple(r) for r in x} for x in (got.collect(), want.fetchall()))
    assert a == b and sum(r[6] for r in a.values()) > 20
