"""Each operator against a brute-force version, and on odd and empty input."""

import math
import os
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lastmile.llm import langid, licenses, minmax_dedup, mixing, packing, ppm, qalsh, quality, subspace_dedup, textops, toxicity
from lastmile.llm.textops import crc_remainder


def _crc(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


def _texts(docs):
    return [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]


def test_words_are_those_of_the_contract():
    docs = [b"", b"  A b\x0ba ", "É é".encode(), b"x"]
    w = textops.Words(docs)
    assert np.diff(w.offsets).tolist() == [0, 3, 2, 1]
    h = w.hashes.tolist()
    assert h[0] == h[2] == textops.word_hash(b"a") and h[1] == textops.word_hash(b"b") and len(set(h)) == 5


def test_crc_remainder(spark):
    ids = [0, 7, 12345, None]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i bigint").select(crc_remainder("i", 10)).collect()]
    assert got == [_crc(i, 10) for i in ids]


def _sets(rows):
    out = []
    for i, t in rows:
        w = t.lower().split()
        out.append((i, {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()))
    return out


def test_near_duplicates(odd_docs, no_docs):
    rows = _sets(_texts(odd_docs))
    group = list(range(len(rows)))
    for _ in rows:
        for x, (_, a) in enumerate(rows):
            for y, (_, b) in enumerate(rows):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    group[x] = group[y] = min(group[x], group[y])
    smallest = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            smallest[g] = min(smallest.get(g, i), i)
    want = sorted(((i, len(s), smallest.get(g)) for g, (i, s) in zip(group, rows)), key=str)
    found = minmax_dedup.near_duplicates(odd_docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert minmax_dedup.near_duplicates(no_docs).count() == 0


def test_one_of_each_keeps_columns(odd_docs):
    kept = minmax_dedup.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.select("doc_id").collect()) == [0, 1, 4, 5, 6, 7, 8, 10, 11]


def test_one_of_each_decides_by_row(spark):
    """Null and repeated ids: different texts all stay, copies go, whatever id they have."""
    texts = [" ".join(f"{a}{j}" for j in range(60)) for a in "abcdef"]
    rows = [
        (None, texts[0]), (None, texts[1]), (None, None), (None, ""),
        (7, texts[2]), (7, texts[3]), (7, texts[3]), (8, texts[2] + " tail"), (8, texts[4]),
        (9, texts[5]), (None, texts[5]),
    ]
    got = minmax_dedup.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    named = [(r.doc_id, r.text) for r in got if r.doc_id is not None]
    assert sorted(named) == [(7, texts[2]), (7, texts[3]), (8, texts[4]), (9, texts[5])]
    loose = [r.text for r in got if r.doc_id is None and r.text]
    assert sorted(loose) == texts[:2]
    assert sum(r.doc_id is None and not r.text for r in got) == 2


def test_near_copies_without_ids_link(spark):
    """Classes whose rows all have a null id take part in links, also as the middle of a chain."""
    words = [f"t{i}" for i in range(200)]
    chain = [" ".join(words[8 * k : 8 * k + 120]) for k in range(3)]
    other = " ".join(f"o{i}" for i in range(120))
    rows = [(1, chain[0]), (None, chain[1]), (3, chain[2]), (None, other), (None, other + " tail")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = minmax_dedup.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id) == [(1, 1), (3, 1)]
    assert sorted(str(r.component_id) for r in found if not r.doc_id) == ["1", "None", "None"]
    kept = minmax_dedup.one_of_each(df).collect()
    assert sorted((str(r.doc_id), r.text[:2]) for r in kept) == [("1", "t0"), ("None", "o0")]


def test_cluster_links_do_not_need_the_centre(spark):
    """A chain whose ends are too far apart: neighbours link, the component spans it."""
    base = [f"t{i}" for i in range(200)]
    texts = [" ".join(base[8 * k : 8 * k + 120]) for k in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minmax_dedup.near_duplicates(df).collect()}
    assert got == {k: 0 for k in range(8)}


def test_language(odd_docs, no_docs):
    chosen = crc_remainder("doc_id", 4) != 2
    rows = langid.identify(odd_docs, chosen, passed=("doc_id",)).collect()
    got = {r.doc_id: r.lang_pred for r in rows}
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(got[i] == "und" for i in (4, 5, 6, 7)) and all(got[i] in ("en", "fr") for i in (1, 8, 9, 10, 11))
    assert langid.identify(no_docs, chosen, passed=("doc_id",)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = crc_remainder("doc_id", 4) == 2
    found = langid.identify(docs.withColumn("held", held), ~held, passed=("doc_id", "lang", "held"))
    assert found.filter("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_toxicity(odd_docs, no_docs, labels, no_labels):
    fold = crc_remainder("doc_id", 5)
    for docs, marks in ((odd_docs, labels), (odd_docs, no_labels), (no_docs, labels)):
        rows = toxicity.score(docs, marks, fold.isin(1, 2, 3), fold == 4, passed=("doc_id",)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    with pytest.raises(ValueError):
        toxicity.score(odd_docs, labels, fold == 1, fold == 4, passed=("score",))


def test_toxicity_finds_planted_words(spark):
    plain = [(i, _plain(i)) for i in range(600)]
    docs = [(i, t + (" grub snark" if i % 5 == 0 else "")) for i, t in plain]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in docs], "doc_id bigint, toxic int")
    fold = crc_remainder("doc_id", 5)
    rows = toxicity.score(df, marks, fold.isin(1, 2, 3), fold == 4, passed=("doc_id",)).collect()
    held = [(r.score >= 0.5, r.doc_id % 5 == 0) for r in rows if _crc(r.doc_id, 5) == 0]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_toxicity_unknown_words_are_no_evidence(spark):
    """Also where one class has far fewer words than the other."""
    rows = [(_plain(i) + (" grub" if i < 5 else ""), int(i < 5)) for i in range(100)]
    model = toxicity._models(spark.createDataFrame(rows, "text string, toxic int"))
    unseen = toxicity.evidence([b"quite different words " * 50], model)
    assert np.abs(unseen).max() == 0 and toxicity.evidence([b"grub"], model)[0, 0] > 0


def _plain(i):
    return " ".join(f"v{(i * 7 + j * 13) % 50}" + "abcdefghij"[(i + j) % 10] for j in range(40))


def test_quality(odd_docs, no_docs, labels, no_labels):
    train = crc_remainder("doc_id", 3) != 1
    for docs, marks in ((odd_docs, labels), (odd_docs, no_labels), (no_docs, labels)):
        rows = quality.score(docs, marks, train, passed=("doc_id",)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        if marks is no_labels:
            assert all(r.score == 0.5 for r in rows)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    p = quality.fit(x[:3000], y[:3000]).score(x[3000:])
    assert ((p >= 0.5) == y[3000:]).mean() > 0.95


def test_language_filter_of_many_languages(spark):
    """70 languages (two words a mask), against sets of n-grams per language."""
    rng = np.random.default_rng(11)
    stock = [["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(40)] for _ in range(70)]
    rows = [(i, " ".join(rng.choice(stock[i % 70], 30)), f"l{i % 70:02d}") for i in range(70 * 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    train = [r for r in rows if r[0] < 70 * 4]
    counts: dict = {}
    for _, t, l in train:
        g, use = langid._grams([t.encode()])
        for c in g.codes[use].tolist():
            of = counts.setdefault(c, {})
            of[l] = of.get(l, 0) + 1
    total: dict = {}
    for of in counts.values():
        for l, n in of.items():
            total[l] = total.get(l, 0) + n
    holds = {}
    for c, of in counts.items():
        rate = {l: n / total[l] for l, n in of.items()}
        top = max(rate.values())
        holds[c] = {l for l, r in rate.items() if r >= langid.FLOOR and r >= langid.SHARE * top}
    found = {r.doc_id: r for r in langid.identify(df, F.col("doc_id") < 70 * 4, passed=("doc_id",)).collect()}
    for i, t, l in rows:
        g, use = langid._grams([t.encode()])
        codes = g.codes[use].tolist()
        share = {m: sum(m in holds.get(c, ()) for c in codes) / len(codes) for m in total}
        assert abs(found[i].score - max(share.values())) < 1e-3
        assert share[found[i].lang_pred] > max(share.values()) - 1e-3
    assert all(found[i].lang_pred == l for i, _, l in rows)


def test_language_limit(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rows = [(i, "some words here", "aa") for i in range(3)] + [(i, "autres mots encore", "bb") for i in range(3, 5)]
    df = spark.createDataFrame(rows + [(9, "weitere dinge", "cc")], "doc_id bigint, text string, lang string")
    assert langid.learn(df, F.lit(True)).languages == ["aa", "bb"]
    assert [langid.filter_shape(n) for n in (1, 64, 65, 129)] == [(1, 1 << 22), (1, 1 << 22), (2, 1 << 22), (3, 1 << 21)]


def test_licenses(odd_docs, no_docs, spark):
    texts = ["Released under the MIT License. mit license", "GNU General Public License, version 3", "mit-licensed", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert (rows[0].n_words, rows[0].n_base, rows[0].first_word, rows[0].last_word, rows[0].labels) == (7, 2, 3, 5, "mit")
    assert (rows[1].base_labels, rows[1].labels, rows[1].score) == ("gpl", "gpl,gpl-3", 1.0)
    assert (rows[2].n_words, rows[2].n_base, rows[2].labels, rows[2].first_word) == (2, 0, "", None)
    assert (rows[3].n_words, rows[3].score) == (0, 0.0)
    assert licenses.scan(odd_docs).count() == odd_docs.count() and licenses.scan(no_docs).count() == 0


def test_licenses_of_many_long_templates(spark):
    """Two hundred whole notices, against every template tried at every word of every text."""
    rng = np.random.default_rng(5)
    notices = [[f"n{x}" for x in rng.integers(0, 300, 80)] for _ in range(200)]
    templates = tuple(
        licenses.Template(f"t{k}", tuple(ws), ((5, 12), (50 + k % 9, 60)), base=k % 7 == 0) for k, ws in enumerate(notices)
    )
    texts = []
    for i in range(60):
        ws = list(notices[(i * 37) % 200])
        if i % 3 == 1:
            ws[20] = "changed"
        if i % 3 == 2:
            ws[8] = "broken"
        texts.append(["before"] * (i % 5) + ws + notices[i] * (i % 2))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: sorted((p.label, p.start, p.standing) for p in r.places) for r in licenses.scan(df, templates=templates).collect()}
    for i, ws in enumerate(texts):
        want = []
        for t, must in zip(templates, [t.mandatory for t in templates]):
            for s in range(len(ws)):
                if all(s + j < len(ws) and ws[s + j] == t.words[j] for j in must):
                    standing = sum(s + j < len(ws) and ws[s + j] == x for j, x in enumerate(t.words))
                    want.append((t.label, s, standing))
        assert got[i] == sorted(want)
    assert sum(map(len, got.values())) >= 60


def test_packing_round_trip(odd_docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = sorted(
        [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in odd_docs.select("text").collect()
    )
    pieces = packing.packed(odd_docs.coalesce(1), with_ids=True).toPandas()
    assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length for p in pieces.itertuples())
    total = 0
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]]
        size = int(s.length.sum())
        assert size <= 2048 and (size & (size - 1)) == 0
        total += size
    assert total == sum(map(len, want))
    once = pieces[pieces.doc_id.isin([4, 8, 9, 10, 11])].sort_values(["doc_id", "start"])
    whole = [sum((list(i) for i in g.ids), []) for _, g in once.groupby("doc_id")]
    assert all(w in want for w in whole) and [len(w) for w in whole] == once.groupby("doc_id").doc_tokens.first().tolist()
    assert packing.packed(no_docs).count() == 0


def test_encoder_gives_the_tokenizers_ids():
    """Random strings of signs that words are cut at, special tokens and characters of every plane."""
    import random

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    draw = random.Random(4)
    signs = ["abcXYZéñßЖω 12٣½  \t\n\r\x0b\x1c\x85\xa0!?.,-'_“€ 漢😀\x00\u0301", "abcXYZéñß  12½ \n\t\xa0\x85\x1c\x1f!?.,ÀЖω·՚"]
    texts = ["".join(draw.choice(s) for _ in range(draw.randint(0, 50))) for s in signs for _ in range(3000)]
    texts += ["Hi <|endoftext|> x", "<|endoftext|>", " ", "\n", " a", "a ", "  a", "\n\na", "it's we'll", "x" * 5000]
    encoder = packing.Encoder(packing.tokenizer_path())
    encoder.pieces.SLOTS = 1 << 6  # most entries are replaced again and again
    encoder.pieces.reset()
    for _ in range(2):
        got = encoder.encode_all(texts)
        assert [g.tolist() for g in got] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_encoder_tells_words_of_equal_bytes_apart():
    """Words of one and two bytes a character, of up to 8, 16, 64 and more bytes, with one beginning."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ends = [" " + "a" * n + x for n in (6, 7, 8, 14, 15, 16, 31, 62, 63, 64, 200) for x in ("", "b", "c", "é", "Ж", "ж")]
    texts = ["\x01\x00", "\x01 Ж", "\x00", "\x00\x00 Ж", "\x00\x00\x00", "\x01 ÿ", *ends, "".join(ends), "".join(ends[::-1])]
    encoder = packing.Encoder(packing.tokenizer_path())
    for _ in range(2):
        got = encoder.encode_all(texts)
        assert [g.tolist() for g in got] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_encoder_encodes_new_words_in_one_call():
    encoder = packing.Encoder(packing.tokenizer_path())
    calls, encode = [], encoder.pieces.encode
    encoder.pieces.encode = lambda words: calls.append(words) or encode(words)
    texts = [f"word{i} and\n\tmore {i * 7919}  " for i in range(500)]
    encoder.encode_all(texts)
    assert len(calls) == 1 and isinstance(calls[0], list) and len(calls[0]) > 500
    encoder.encode_all(texts)
    assert sum(map(len, calls[1:])) < 10  # a few words share a slot


def test_packing_of_many_equal_texts(spark, monkeypatch):
    """Copies of one text are dealt over several parts; every row is packed once."""
    monkeypatch.setattr(packing, "PARTITION_TOKENS", 4096)
    rows = [(i, "the same words again and again " * 20 if i % 3 else f"other words {i} " * 20) for i in range(300)]
    pieces = packing.packed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    whole = {}
    for p in pieces:
        whole[p.doc_id] = whole.get(p.doc_id, 0) + p.length
    assert sorted(whole) == list(range(300)) and all(whole[p.doc_id] == p.doc_tokens for p in pieces)
    assert len({p.sequence_id >> 36 for p in pieces if p.doc_id % 3}) > 2


def test_packing_takes_lexical_neighbours():
    terms = [np.array(t) for t in ([1, 2, 3], [7, 8, 9], [1, 2, 4], [7, 8, 5], [20, 21], [30, 31], [40, 41])]
    windows = packing.pack(np.array([1000, 1000, 1048, 1048, 5, 5, 5]), terms)
    assert {d for d, _, _ in windows[0]} == {0, 2} and {d for d, _, _ in windows[1]} == {1, 3}


def test_packing_finds_neighbours_in_other_partitions(spark):
    """Related documents share sequences though every one is read in another partition."""
    kinds = [" ".join(f"{k}{j}" for j in range(12)) for k in ("alpha", "beta", "gamma", "delta")]
    rows = [(i, f"{kinds[i % 4]} " * 12 + f"end {i}") for i in range(48)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(12, "doc_id")
    pieces = packing.packed(df).collect()
    assert {p.doc_id for p in pieces} == set(range(48)) and sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p.doc_id)
    pairs = [a % 4 == b % 4 for group in by.values() for a in group for b in group if a != b]
    assert sum(pairs) >= 0.6 * len(pairs)


def test_packing_counts_term_frequency():
    terms = [np.array([1]), np.array([1, 2]), np.array([1, 3])]
    index = packing.Index(terms, np.array([4.0, 4, 4]), [np.array([4]), np.array([1, 3]), np.array([3, 1])], np.ones(4), 4.0)
    assert index.scores(0)[2] > index.scores(0)[1] > 0


def test_packing_index_without_used_documents(monkeypatch):
    """Used documents leave the index; scores of the others, and so the windows, stay the same."""
    rng = np.random.default_rng(5)
    terms = [np.unique(rng.integers(0, 60, 12)) for _ in range(200)]
    index = packing.Index(terms, np.full(200, 12.0))
    before, some = [index.scores(i) for i in range(200)], rng.random(200) < 0.4
    index.keep(some)
    assert len(index.posting) < 0.6 * sum(map(len, terms))
    assert all((index.scores(i) == np.where(some, before[i], 0)).all() for i in range(200))
    lengths, windows = rng.integers(1, 900, 200), []
    for share in (0.0, 0.8, 1.0):
        monkeypatch.setattr(packing, "KEPT", share)
        windows.append(packing.pack(lengths, terms))
    assert windows[0] == windows[1] == windows[2]


def test_packing_index_as_table_gives_the_same_scores(monkeypatch):
    """To the last bit, also after used documents left, and for documents without useful words."""
    rng = np.random.default_rng(6)
    terms = [np.unique(rng.integers(0, 60, n)) for n in rng.integers(0, 20, 150)]
    counts = [rng.integers(1, 9, len(t)) for t in terms]
    some = rng.random(150) < 0.6
    scores = []
    for sparse in (packing.SPARSE, 0):
        monkeypatch.setattr(packing, "SPARSE", sparse)
        index = packing.Index(terms, np.full(150, 9.0), counts)
        assert (index.table is not None) == (sparse > 0)
        whole = [index.scores(i) for i in range(150)]
        index.keep(some)
        scores.append([*whole, *[index.scores(i) for i in range(150)]])
        index.keep(np.zeros(150, dtype=bool))
        assert not any(index.scores(i).any() for i in range(150))
    assert all((a == b).all() for a, b in zip(*scores))
    assert packing.Index([np.zeros(0, dtype=np.int64)] * 3, np.ones(3)).scores(1).tolist() == [0, 0, 0]


def test_packing_reads_the_tokenizer_once_a_worker():
    path = packing.tokenizer_path()
    assert packing._encoder(path) is packing._encoder(path)
    packing._encoder.cache_clear()


def test_packing_reads_no_tokenizer_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(packing, "Encoder", None)  # workers import their own
    pieces = packing.packed(spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string")).collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == {1: 3, 2: 1}


def test_component_rounds_have_short_plans(spark):
    import re

    from lastmile.llm.graph import connected_components

    runs = spark._jsparkSession.sharedState().statusStore()
    before = runs.executionsList().size()
    edges = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 31), (None, 5), (50, 20)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == {**{i: 0 for i in (*range(21), 50)}, 30: 30, 31: 30}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    plans = [runs.executionsList().apply(i).physicalPlanDescription() for i in range(before, runs.executionsList().size())]
    assert 1 <= max(len(re.findall(r"^\(\d+\) \w+Join", p, re.M)) for p in plans) <= 10


def _ppm_brute(texts, train, order=ppm.ORDER):
    trie = {}
    for t, use in zip(texts, train):
        b = b"\0" * order + t + b"\xff"
        for j in range(order, len(b)) if use else ():
            for k in range(order + 1):
                c = trie.setdefault(b[j - k : j], {})
                c[b[j]] = c.get(b[j], 0) + 1

    def cost(context, byte):
        p, gone = 0.0, set()
        for k in range(order, -1, -1):
            c = {x: n for x, n in trie.get(context[order - k :], {}).items() if x not in gone}
            total, kinds = sum(c.values()), len(c)
            if byte in c:
                return p + math.log10(c[byte] / (total + kinds))
            if kinds:
                p += math.log10(kinds / (total + kinds))
            gone |= set(c)
        return p - math.log10(256 - len(gone))

    out = []
    for t in texts:
        b = b"\0" * order + t + b"\xff"
        out.append(sum(cost(b[j - order : j], b[j]) for j in range(order, len(b))))
    return out


def test_ppm(odd_docs, no_docs):
    short = odd_docs.filter("doc_id is null or doc_id <> 10")
    held = crc_remainder("doc_id", 10) == 0
    rows = _texts(short)
    train = [_crc(i, 10) != 0 for i, _ in rows]
    tokens = [[*t.lower().split(), None] for _, t in rows]
    counts = {}
    for ws, use in zip(tokens, train):
        for w in ws if use else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for (i, _), ws, s in zip(rows, tokens, _ppm_brute([t for _, t in rows], train)):
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want.append((i, len(ws), sum(w in counts for w in ws), n, round(base, 6), round(s, 6)))
    found = ppm.score(short, ~held, passed=("doc_id",)).collect()
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert ppm.score(no_docs, ~held, passed=("doc_id",)).count() == 0
    with pytest.raises(ValueError):
        ppm.score(short.withColumn("score", F.lit(1.0)), ~held, passed=("score",))
    unlearnt = ppm.score(short.filter("doc_id = 8"), F.lit(False)).first()
    assert unlearnt.train_tokens == 0 and abs(unlearnt.score + 8 * math.log10(256)) < 1e-9


def test_ppm_deals_one_id_and_one_text_to_many_parts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "PART_BYTES", 4 << 10)
    rows = [(7, "the same words again and again " * 3, "x")] * 400 + [(i, f"word{i} of its own", "x") for i in range(100, 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, part string")
    sizes = [r["count"] for r in ppm._dealt(df.select("doc_id", "text")).filter("doc_id = 7").groupBy("part").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 80
    found = ppm.score(df, F.lit(True), passed=("doc_id",))
    assert found.count() == 500
    one = found.filter("doc_id = 7").agg(F.min("score"), F.max("score"), F.max("n_tokens")).first()
    assert one[1] - one[0] < 1e-6 and one[2] == 19


def _odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        v = rng.normal(size=16)
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
        if i % 10 == 0:
            rows.append((1000 + i, [float(np.float32(x)) for x in v + 0.05 * rng.normal(size=16)], i % 3))
            rows.append((2000 + i, rows[-2][1], i % 3))
    rows += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 16, 1), (5003, [1.0, None], 1), (5004, [float("nan")] * 16, 1),
             (5005, rows[0][1], None), (5006, [1.0, 2.0], 1), (5007, [2.0, 4.0], 1), (None, rows[1][1], 1)]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def _usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_subspace_dedup(spark):
    rows, df = _odd_vectors(spark)
    good = [r for r in rows if _usable(r[1]) and r[2] is not None and r[0] is not None]
    links = {r[0]: set() for r in rows}
    for a in good:
        for b in good:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[a[0]].add(b[0])
    low = {r[0]: r[0] for r in rows}
    for _ in range(10):
        for i in low:
            low[i] = min([low[i], *[low[j] for j in links[i]]]) if links[i] else low[i]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in subspace_dedup.near_duplicates(df).collect()}
    assert got == {i: (len(links[i]), low[i], low[i] == i) for i in low}
    assert subspace_dedup.near_duplicates(df.limit(0)).count() == 0


def _near_copies(n, seed=8):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=24)
    return [[float(np.float32(x)) for x in v + 0.02 * rng.normal(size=24)] for _ in range(n)]


def test_subspace_links_are_counted_not_listed(spark, monkeypatch):
    tables = {}
    keep = subspace_dedup.written

    def noted(df, name, **how):
        tables[name] = out = keep(df, name, **how)
        return out

    monkeypatch.setattr(subspace_dedup, "written", noted)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(_near_copies(150))], "vec_id bigint, embedding array<float>, label int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        out = subspace_dedup.near_duplicates(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = [tuple(r) for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(got) == [(i, 149, 0, i == 0) for i in range(150)]
    assert tables["subspace-links"].count() <= 150  # 11,175 pairs
    assert "BroadcastHashJoin" not in plan  # none by the size of a file


@pytest.mark.parametrize("rows, values", [(7, 1 << 21), (1 << 15, 160), (1, 1)])
def test_subspace_tiles_give_the_same_links(spark, monkeypatch, rows, values):
    df = _odd_vectors(spark)[1].union(
        spark.createDataFrame([(9000 + i, v, i % 2) for i, v in enumerate(_near_copies(40))], "vec_id bigint, embedding array<float>, label int")
    ).filter("vec_id is null or vec_id % 7 < 3 or vec_id >= 5000")
    want = sorted(map(str, subspace_dedup.near_duplicates(df).collect()))
    monkeypatch.setattr(subspace_dedup, "TILE_ROWS", rows)
    monkeypatch.setattr(subspace_dedup, "TILE_VALUES", values)
    assert sorted(map(str, subspace_dedup.near_duplicates(df).collect())) == want


def test_subspace_repeated_id_counts_all_rows_of_a_partner(spark):
    a, b, c = _near_copies(3)
    far = [-x for x in a]
    df = spark.createDataFrame(
        [(1, a, 1), (2, b, 1), (2, far, 1), (3, c, 1), (3, c, 1)], "vec_id bigint, embedding array<float>, label int"
    )
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in subspace_dedup.near_duplicates(df).collect())
    assert got == [(1, 4, 1), (2, 3, 1), (2, 3, 1), (3, 4, 1), (3, 4, 1)]


def test_subspace_functions_travel_by_value(tmp_path):
    place = tmp_path / "functions"
    place.write_bytes(cloudpickle.dumps((subspace_dedup._classes, subspace_dedup._links)))
    load = f"import pickle, pyspark; pickle.load(open({str(place)!r}, 'rb'))"
    subprocess.run([sys.executable, "-c", load], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, check=True)


def test_qalsh_recall_and_ties(spark):
    rows, df = _odd_vectors(spark)
    found = qalsh.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = [r for r in rows if _usable(r[1]) and r[0] is not None]
    hit = total = 0
    for q in good:
        if q[0] % 20:
            continue
        x = np.array(q[1])
        best = sorted(((-float(x @ np.array(r[1])), r[0]) for r in good if r[0] != q[0] and len(r[1]) == len(q[1])))[:10]
        mine = sorted(by[q[0]])
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        hit += len({m[1] for m in mine} & {b[1] for b in best})
        total += len(best)
    assert hit >= 0.9 * total
    assert qalsh.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_mixing_meets_targets(spark, odd_docs, no_docs, labels, no_labels):
    docs = [(i, _plain(i) + (" zig zag zog" if i % 4 == 0 else "")) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i, _ in docs if i % 2 == 0], "doc_id bigint, quality int, toxic int")
    out = mixing.rates(df, marks, {"good": 0.6, "low": 0.4})
    p = [F.sum(F.col("rate") * F.col("__t") * F.get("__p", F.lit(k))) for k in (0, 1)]
    a, b, t = out.agg(*p, F.sum("__t")).first()
    assert abs(a / t - 0.6) < 1e-3 and abs(b / t - 0.4) < 1e-3
    assert out.filter("rate < 0 or abs(copies - rate) >= 1").isEmpty()
    for d, m in ((odd_docs, labels), (odd_docs, no_labels), (no_docs, labels)):
        kept = mixing.mixed(d, m)
        assert kept.columns == d.columns
        assert kept.count() >= 0
