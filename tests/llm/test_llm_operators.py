"""Each operator against brute force, a round trip or held-out accuracy, and its defined results for odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import bpe_codec, decontaminate, jaccard_join, license_scan, line_crf, neural_partitions, preference_format, queries, suffix_dedup, toxicity, url_rules
from ledgerlark.llm.common import split_rule, texts

ODD = [(1, None, "x"), (2, "", "x"), (3, "a", None), (4, "a", "y"), (4, "a", "y"), (5, "é\x00   x" * 3, "y"), (6, "word " * 30000, "y")]
DOCS = "doc_id long, text string, score string"  # an extra column whose name an operator uses itself


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, sf_dir, same_rows, name):
    same_rows(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name])


# ---- BPE ----------------------------------------------------------------------------------------------


def test_bpe_agrees_with_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe_codec.vocabulary())
    own, rnd = bpe_codec.codec(bpe_codec.vocabulary()), random.Random(1)
    letters = [*"abc ABC's'll'RE123  \t\n\x1c\x85\xa0éÉßΣσςİıﬁ中日́ÅΩ😀!?", "<|endoftext|>", "<|startoftext|>", "thing", "over"]
    for _ in range(2000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        got = library.encode(text, add_special_tokens=False)
        assert own.encoded(text) == got.ids, text
        assert own.decoded(got.ids) == library.decode(got.ids, skip_special_tokens=False)
    assert own.guessed and own.exact


def test_bpe_has_the_library_characters():
    """Every code point, alone in a word, twice, and as a capital or small letter beside others; and composed pairs."""
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe_codec.vocabulary())
    own = bpe_codec.codec(bpe_codec.vocabulary())
    texts_ = [f"a{chr(c)}{chr(c)}b {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x32000 or c % 97 == 0)]
    texts_ += [f"a{chr(c)}{m}" for c in range(0x250, 0x32000) if not 0xD800 <= c < 0xE000 for m in "\u0301\u0307\u093c" if unicodedata.category(chr(c)) != "Cn"]
    for lo in range(0, len(texts_), 20_000):
        part = texts_[lo : lo + 20_000]
        ids, at = own.encoded_all(pa.array(part))
        for k, got in enumerate(library.encode_batch(part, add_special_tokens=False)):
            assert ids[at[k] : at[k + 1]].tolist() == got.ids, ascii(part[k])


def test_bpe_digests_are_the_library_s(spark, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe_codec.vocabulary())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, "Long " * 300_000 + "<|endoftext|>ÄÖ don't 12" * 9), (-2, "x" * 20_000), (-3, None), (-4, " \n\u3000a\u2003b")], docs.schema))
    found = {r.doc_id: r for r in bpe_codec.encode(docs, "word_bpe_49k.json", outputs=("digests", "ids", "decoded")).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    for r in rows:
        got = library.encode(r.text or "", add_special_tokens=False)
        decoded = library.decode(got.ids, skip_special_tokens=False)
        assert found[r.doc_id].ids == got.ids and found[r.doc_id].decoded == decoded and found[r.doc_id].n_tokens == len(got.ids)
        assert found[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, got.ids)).encode()).hexdigest()
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_pair_check_is_merging():
    own, rnd = bpe_codec.codec(bpe_codec.vocabulary()), random.Random(2)
    inner = [i for n, i in own.ids.items() if not n.endswith(own.end) and own.is_sound(i)]
    every = [i for i in own.ids.values() if own.is_sound(i)]
    pairs = [(rnd.choice(inner), rnd.choice(every)) for _ in range(3000)]
    fits = own.pairs_fit(*(np.array(x) for x in zip(*pairs, strict=True)))
    assert [own.merged(own.parts(a) + own.parts(b)) == [a, b] for a, b in pairs] == fits.tolist()


def test_bpe_odd_rows(odd, none):
    rows = bpe_codec.encode(odd, outputs=("ids", "decoded", "digests")).collect()
    assert len(rows) == len(ODD) and sorted(r.n_tokens for r in rows)[:2] == [0, 0]
    assert all(len(r.ids) == r.n_tokens and r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() for r in rows)
    assert bpe_codec.encode(none).collect() == []


# ---- decontamination ----------------------------------------------------------------------------------


def test_decontamination_finds_all_exact_passages(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.regions(docs, items).collect()}
    bodies, passages = docs.collect(), items.collect()
    assert {(d.doc_id, i.item_id) for d in bodies for i in passages if i.text in d.text} <= found
    kept = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    assert kept == {d.doc_id for d in bodies} - {d for d, _ in found}


def levenshtein_within(a: bytes, b: bytes) -> int:
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_is_brute_force_on_edited_passages():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(12, 40)))) for i in range(6)]
    index = decontaminate.Index(items)
    for _ in range(60):
        body = [*rnd.choice(items)[1]]
        for _ in range(rnd.randint(0, 16)):
            at = rnd.randrange(len(body))
            body[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "yz"])
        text = " ".join(rnd.choice(words) for _ in range(20)) + " " + "".join(body).upper() + " " + " ".join(rnd.choice(words) for _ in range(20))
        data, offsets = texts(pa.array([text], pa.large_string()))
        norm = decontaminate.normalised(data, offsets)[0].tobytes()
        want = {index.items[w] for w, window in enumerate(index.windows) if levenshtein_within(window.tobytes(), norm) <= index.budgets[w]}
        assert {r["item_id"] for r in decontaminate.judged(index, data, offsets)} == want


def found_in(index, text: str) -> list[tuple[int, int, int]]:
    found = decontaminate.judged(index, *texts(pa.array([text], pa.large_string())))
    return [(r["item_id"], r["n_windows"], r["distance"]) for r in found]


def test_decontamination_finds_partial_quotes_at_every_offset():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    item = " ".join(rnd.choice(words) for _ in range(90))[:300].strip()
    index, around = decontaminate.Index([(7, item), (8, "klm nop " * 20)]), "uvwxyz " * 20
    for size in (96, 100, 120, 132):
        for at in range(len(item) - size + 1):
            quote = item[at : at + size]
            if quote == quote.strip():
                assert [r[0] for r in found_in(index, around + quote + around)] == [7], (size, at)
                # Five edits anywhere in a window's length count at each offset too.
                edited = [*quote]
                for i in rnd.sample(range(96), 5):
                    edited[i] = "q"
                assert [r[0] for r in found_in(index, around + "".join(edited) + around)] == [7], (size, at)
    assert found_in(index, around + item + around) == [(7, len(item) - 95, 0)]
    assert found_in(index, around + item[40:120] + around) == []


def test_decontamination_finds_short_items_between_word_borders():
    index = decontaminate.Index([(1, "What is the capital of Peru?"), (2, "Año 7"), (3, "what is the CAPITAL of peru"), (4, "?!"), (5, "seven words that stand in no row")])
    rows = ["What is the capital of Peru?", "x y, what is\nthe capital of PERU", "so what is the capital of peru now", "what is the capital of perus", "xwhat is the capital of peru", "what is the capital", "of peru", "", None, "7 AÑO 7", "año 77"]
    found = decontaminate.judged(index, *texts(pa.array(rows, pa.large_string())))
    assert [(r["row"], r["item_id"], r["n_windows"], r["distance"]) for r in found] == [(0, 1, 1, 0), (0, 3, 1, 0), (1, 1, 1, 0), (1, 3, 1, 0), (2, 1, 1, 0), (2, 3, 1, 0), (9, 2, 1, 0)]


def test_decontamination_keeps_all_texts_of_an_id_and_those_without(spark):
    one, two, bare, other = (" ".join(w + str(i) for i in range(20)) for w in ("alpha", "beta", "gamma", "delta"))
    items = spark.createDataFrame([(1, one), (1, two), (1, two), (1, None), (None, bare), (None, other), (None, bare), (2, "short one"), (2, "shorter")], "item_id long, text string")
    docs = spark.createDataFrame([(1, one, "x"), (2, two, "x"), (3, f"{one} {two}", "x"), (4, bare, "x"), (5, f"{other} {bare}", "x"), (6, "a short one, a shorter one", "x"), (7, "none", "x"), (7, one, "x"), (7, one, "x")], DOCS)
    found = sorted(((r.doc_id, r.item_id, r.n_windows) for r in decontaminate.regions(docs, items).collect()), key=repr)
    n, m, o, p = (len(t) - 95 for t in (one, two, bare, other))
    windows = {(r[0], r[1]): r[2] for r in found}
    assert [f[:2] for f in found] == [(1, 1), (2, 1), (3, 1), (4, None), (5, None), (5, None), (6, 2), (7, 1), (7, 1)]
    assert windows[1, 1] == n and windows[2, 1] == m and windows[3, 1] == n + m and windows[4, None] == o and windows[6, 2] == 2
    assert sorted(f[2] for f in found if f[0] == 5) == sorted((o, p))
    assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [7]
    small = list(decontaminate.blocks(items, 150))
    assert [{t for _, t in b} for b in small] == [{x} for x in sorted((bare, other))] + [{one, two}, {"short one", "shorter"}]


def test_decontamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, "word " * 20), (4, "word " * 20)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.distance) for r in decontaminate.regions(odd, items).collect()] == [(6, 4, 0)]
    assert decontaminate.clean(odd, items).columns == odd.columns and decontaminate.clean(odd, items).count() == len(ODD) - 1
    assert decontaminate.regions(none, items).collect() == [] and decontaminate.regions(odd, items.limit(0)).collect() == []


# ---- neighbours ---------------------------------------------------------------------------------------


def test_neighbours_recall(spark, sf_dir):
    rows = queries.QUERIES["op2_neural_partitions"](spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    got = collections.defaultdict(list)
    for r in rows:
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    right = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -9
        best = ids[np.lexsort((ids, -s))[:20]]
        mine = sorted(got[ids[i]])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and [s for _, _, s in mine] == sorted((s for _, _, s in mine), reverse=True)
        right, total = right + len({*best} & {v for _, v, _ in mine}), total + 20
    assert right >= 0.9 * total


def test_neighbours_recall_at_a_larger_scale(spark):
    """On the 2,000 vectors of sf0.1, against brute force."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in vectors.collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    found: dict[int, set[int]] = {}
    for r in neural_partitions.search(vectors, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(found[q] & set(ids[np.lexsort((ids, -np.where(ids == q, -np.inf, x @ x[k])))[:20]].tolist())) / 20 for k, q in enumerate(ids.tolist()) if q % 20 == 0]
    assert np.mean(hits) >= 0.9


def test_neighbours_route_and_reach(monkeypatch):
    rnd = np.random.default_rng(0)
    centres = rnd.normal(size=(12, 16))
    x = np.repeat(centres, 60, 0) + 0.2 * rnd.normal(size=(720, 16))
    router = neural_partitions.fit(x[::2], x[1::2][:100], 8, 10)
    assert 1 <= router.probes < 8  # clustered vectors need few parts
    part = neural_partitions.balanced_parts(x / np.linalg.norm(x, axis=1, keepdims=True), np.argsort(-(x @ x.T), 1)[:, 1:6], 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.05 * len(x) / 8)


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 7.0) for r in data], "vec_id long, embedding array<float>, score double")
    got = sorted(tuple(r) for r in neural_partitions.search(df, F.col("vec_id") % 20 == 0, 20).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 2, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 0.0)]
    assert neural_partitions.search(df.limit(0), F.col("vec_id") % 20 == 0, 20).collect() == []


def test_neighbours_count_an_id_once(spark):
    """Thirty copies of near vectors and one id with two vectors must not take the places of others; best score counts."""
    rnd = np.random.default_rng(2)
    data = [(i, rnd.normal(size=4).tolist()) for i in range(40)]
    data += 30 * [data[1], data[2]] + [(3, (3 * rnd.normal(size=4)).tolist()), data[20]]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got: dict[int, list] = {}
    for r in neural_partitions.search(df, F.col("vec_id") % 20 == 0, 12).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    right = 0
    for q in (0, 20):
        best: dict[int, float] = {}
        for i, v in data:
            if i != q:
                best[i] = max(best.get(i, -np.inf), float(np.dot(data[q][1], v)))
        brute = sorted(best, key=lambda i: (-best[i], i))[:12]
        assert [r for r, _, _ in got[q]] == list(range(1, 13)) and len({i for _, i, _ in got[q]}) == 12
        assert all(s <= round(best[i], 9) for _, i, s in got[q])
        right += len({i for _, i, _ in got[q]} & {*brute})
    assert right >= 0.9 * 24
    x, ids = np.array([v for _, v in data]), np.array([i for i, _ in data])
    _, found, _ = neural_partitions.top(x[:1], ids[:1], x, ids, 12)
    best = {i: max(float(x[0] @ v) for j, v in data if j == i) for i in set(ids.tolist()) - {0}}
    assert found.tolist() == sorted(best, key=lambda i: (-best[i], i))[:12]


def test_neighbours_blocks_are_whole(spark, monkeypatch):
    monkeypatch.setattr(neural_partitions, "BLOCK", 7)
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(60, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = collections.Counter(r.query_id for r in neural_partitions.search(df, F.col("vec_id") % 20 == 0, 20).collect())
    assert got == {0: 20, 20: 20, 40: 20}


# ---- classifiers --------------------------------------------------------------------------------------


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = line_crf.learn(docs, labels, split_rule("doc_id", 4) != 2)
    found = line_crf.score(docs, model).join(labels, "doc_id").filter(split_rule("doc_id", 4) == 2).toPandas()
    assert ((found.score >= 0.7) == (found.quality == 1)).mean() >= 0.95


def test_quality_marginals_are_brute_force():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 5):
        unary, trans = rnd.normal(size=n), rnd.normal(size=(2, 2))
        p = np.zeros(n)
        z = 0.0
        for k in range(2**n):
            y = [k >> i & 1 for i in range(n)]
            w = np.exp(sum(unary[i] * y[i] for i in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            z += w
            p += w * np.array(y)
        got, _, scale = line_crf.marginals(line_crf.Chains(np.zeros(n, np.int64)), unary, trans)
        assert np.allclose(got, p / z) and np.isclose(scale.sum(), np.log(z))


def test_quality_in_slices_and_blocks_is_the_plain_one(monkeypatch):
    """Potentials by slices against the whole features, marginals by blocks against line by line."""
    rnd = np.random.default_rng(3)
    rows = ["", "one line", "a\nb\n\na\n" * 9, "x y z! " * 40, "\n", "Tail\n" * 30 + "end"]
    data, offsets = texts(pa.array(rows))
    row, size, x = line_crf.line_features(data, offsets)
    w, trans = rnd.normal(size=x.shape[1]), rnd.normal(size=(2, 2))
    for slice_bytes, lines in ((1 << 20, 1 << 16), (16, 3)):
        monkeypatch.setattr(line_crf, "SLICE", slice_bytes)
        monkeypatch.setattr(line_crf, "LINES", lines)
        found = line_crf.potentials(data, offsets, w)
        assert np.array_equal(found[0], row) and np.array_equal(found[1], size) and np.allclose(found[2], x @ w)
        assert np.array_equal(line_crf.line_features(data, offsets)[2], x)
    plain, _, _ = line_crf.marginals(line_crf.Chains(row), x @ w, trans)
    for block in (1, 2, 5, 256):
        assert np.allclose(line_crf.good_marginals(row, x @ w, trans, block), plain)


def test_quality_of_a_million_lines():
    """Within a few seconds and little memory."""
    import time
    import tracemalloc

    model = line_crf.fit(["Fine words here.\nMore of them."] * 5 + ["$$$ ### !!!\n%%%"] * 5, [1] * 5 + [0] * 5)
    data, offsets = texts(pa.array(["\n" * 1_000_000]))
    tracemalloc.start()
    began = time.perf_counter()
    (score,) = model.scores(data, offsets)
    assert 0 <= score <= 1 and time.perf_counter() - began < 20 and tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_quality_lines():
    data, offsets = texts(pa.array(["a\nbc", "", None, "x\n", "\n"], pa.large_string()))
    start, end, row = line_crf.lines_of(data, offsets)
    assert [(int(r), bytes(data[s:e]).decode()) for s, e, r in zip(start, end, row, strict=True)] == [(0, "a"), (0, "bc"), (1, ""), (2, ""), (3, "x"), (3, ""), (4, ""), (4, "")]


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, split_rule("doc_id", 5) != 0)
    found = toxicity.score(docs, model).join(labels, "doc_id").filter(split_rule("doc_id", 5) == 0).toPandas()
    assert ((found.score >= 0.5) == (found.toxic == 1)).mean() >= 0.95


def test_toxicity_risk_is_the_plain_one():
    """The risk and its gradient against plain sums and differences, on both sides of 0."""
    rnd = np.random.default_rng(4)
    for prior, shift in ((0.2, 0.0), (0.9, 3.0)):
        f_p, f_u = rnd.normal(shift, 2, 7), rnd.normal(-shift, 2, 9)

        def parts(f_p, f_u, prior=prior):
            plus = sum(math.log(1 + math.exp(-f)) for f in f_p) / len(f_p)
            minus = sum(math.log(1 + math.exp(f)) for f in f_u) / len(f_u) - prior * sum(math.log(1 + math.exp(f)) for f in f_p) / len(f_p)
            return prior * plus, minus

        plus, minus = parts(f_p, f_u)
        assert (minus < 0) == (shift > 0)
        value, g_p, g_u = toxicity.risk(f_p, f_u, prior)
        assert value == pytest.approx(plus + max(0.0, minus))
        goal = (lambda a, b: sum(parts(a, b))) if minus >= 0 else (lambda a, b: -parts(a, b)[1])
        for k, g in [*enumerate(g_p), *enumerate(g_u, 7)]:
            step = np.eye(16)[k] * 1e-6
            up, down = (goal(f_p + s * step[:7], f_u + s * step[7:]) for s in (1, -1))
            assert g == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_toxicity_of_long_texts_in_slices(monkeypatch):
    rows = ["some Words here " * 50, "", "an-other éÀ text", "x" * 99]
    data, offsets = texts(pa.array(rows))
    model = toxicity.fit(["some bad words"] * 5 + ["another bad text"] * 5, ["a fine text", "words"] * 5, 0.4)
    whole, cuts = model.scores(data, offsets), toxicity.word_cuts
    monkeypatch.setattr(toxicity, "word_cuts", lambda gap, edges: cuts(gap, edges, 16))
    assert len(model.keys) and np.allclose(whole, model.scores(data, offsets))


def test_toxicity_features_are_words_and_beginnings():
    data, offsets = texts(pa.array(["Élan élan, x", "élan"], pa.large_string()))
    (row, words), *_ = toxicity.features(data, offsets)
    assert row.tolist() == [0, 0, 0, 1] and words[0] == words[1] == words[3] != words[2]


@pytest.mark.parametrize("module", [line_crf, toxicity])
def test_classifiers_odd_rows(spark, odd, none, module):
    labels = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (4, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = module.learn(odd, known, F.lit(True))
        rows = module.score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert module.score(none, module.learn(none, labels, F.lit(True))).collect() == []


# ---- repeated passages --------------------------------------------------------------------------------


def brute_repeats(bodies: list[bytes], depth: int) -> list[list[tuple[int, int]]]:
    seen = collections.Counter(b[i : i + depth] for b in bodies for i in range(len(b) - depth + 1))
    out = []
    for b in bodies:
        spans: list[list[int]] = []
        for i in range(len(b) - depth + 1):
            if seen[b[i : i + depth]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + depth
                else:
                    spans.append([i, i + depth])
        out.append([tuple(s) for s in spans])
    return out


def test_long_prefixes_are_brute_force():
    rnd = random.Random(1)
    for _ in range(150):
        base = bytes(rnd.choice(b"abc"[: rnd.randint(1, 3)]) for _ in range(60))
        strings = []
        for _ in range(rnd.randint(1, 6)):
            a = rnd.randint(0, 30)
            s = bytearray(base[a : a + rnd.randint(0, 40)])
            if s and rnd.random() < 0.5:
                s[rnd.randrange(len(s))] = rnd.choice(b"ab")
            strings.append(bytes(s))
        for depth in (3, 8, 12):
            runs = suffix_dedup.repeated_runs(strings, [1] * len(strings), depth)
            want = brute_repeats(strings, depth)
            got = [suffix_dedup.merged(np.array(r[::2]), np.array(r[1::2]) + depth) if r else [] for r in runs]
            assert got == want


@pytest.mark.parametrize("hot", [1_750_000, 1])
def test_repeats_are_brute_force(spark, sf_dir, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    long = "abcdefghij" * 60
    rows += [(900, None), (901, ""), (902, "x" * 199), (903, "y" * 201), (904, long), (905, "-" + long[:250]), (906, "é" * 150 + "q" * 300), (906, "é" * 150 + "q" * 300), (907, "z" * 5000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    bodies = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), b, spans in zip(rows, bodies, brute_repeats(bodies, 200), strict=True):
        kept = suffix_dedup.rest_of(b, spans)
        want.append((i, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    assert sorted(tuple(r) for r in suffix_dedup.digests(docs).collect()) == sorted(want)
    cut = suffix_dedup.removed(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)


def test_repeats_of_nothing(spark, none):
    assert suffix_dedup.digests(none).collect() == []


def test_cuts_keep_whole_characters():
    body = "aéb".encode()
    assert suffix_dedup.whole_characters(body, [(0, 2)]) == [(0, 1)] and suffix_dedup.whole_characters(body, [(2, 4)]) == [(3, 4)]


# ---- licences -----------------------------------------------------------------------------------------


def test_licences_are_brute_force(spark, odd, none):
    rows = [(r.doc_id, r.text, "x") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += [*ODD, (10, "MIT License mit-license MIT LICENSE", "x"), (11, "General Public License v3 licensed under CC BY-NC 4.0", "x"), (12, "licenseé mit license", "x"), (13, "under the licence of mit", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    want = []
    for i, t, _ in rows:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(k, label) for label, p in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        want.append((i, len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))))
    found = license_scan.scan(docs).collect()
    assert sorted((tuple(r)[:6] for r in found), key=repr) == sorted(want, key=repr)
    assert {r.labels for r in found if r.doc_id == 11} == {"cc-by-nc,gpl", ""} - {""} or any(r.labels == "cc-by-nc,gpl" for r in found if r.doc_id == 11)
    assert all({*r.base_labels.split(",")} - {""} <= {*r.labels.split(",")} and 0 <= r.score <= 1 for r in found)
    assert license_scan.scan(none).collect() == []


def test_licence_templates_are_brute_force(spark):
    rnd, vocabulary = random.Random(8), sorted({w for _, t, _ in license_scan.TEMPLATES for w in t.split()})
    bodies = ["redistribution and use in source and binary forms so or so", "permission to use copy modify is given"] * 6
    for _, text, key in license_scan.TEMPLATES:
        bodies += [text, f"{text} {text}", key, f"x {key}"]
        for _ in range(6):
            bodies.append(" ".join(w if w in key.split() or rnd.random() < 0.5 else rnd.choice(["x", rnd.choice(vocabulary)]) for w in text.split()))
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    total, df = license_scan.frequencies(docs)
    idf = {w: np.log((total + 1) / (n + 1)) + 1e-3 for w, n in df.items()}
    want = {}
    for i, body in enumerate(bodies):
        words, places = body.split(), []
        for label, text, key in license_scan.TEMPLATES:
            parts, key_words = text.split(), key.split()
            at = next(k for k in range(len(parts)) if parts[k : k + len(key_words)] == key_words)
            for start in range(-at, len(words)):
                agreed = sum(idf[p] for k, p in enumerate(parts) if 0 <= start + k < len(words) and words[start + k] == p) / sum(idf[p] for p in parts)
                if words[start + at : start + at + len(key_words)] == key_words and agreed >= license_scan.AGREE:
                    places.append((label, agreed))
        want[i] = ({x for x, _ in places}, len(places), max((a for _, a in places), default=0.0))
    rare = sorted(license_scan.TEMPLATES[5][1].split(), key=lambda w: -idf[w])[:3]
    assert not {*rare} & {*bodies[0].split()} and "bsd" in want[0][0]
    for r in license_scan.scan(docs).collect():
        labels, n, score = want[r.doc_id]
        assert {*r.labels.split(",")} - {""} - {*r.base_labels.split(",")} == labels - {*r.base_labels.split(",")}, bodies[r.doc_id]
        assert r.n_places == n and abs(r.score - score) < 1e-5


def test_native_plans_have_no_python(spark, sf_dir):
    for name in ("op5_license_scan", "op6_url_rules"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


# ---- urls ---------------------------------------------------------------------------------------------


def test_url_rules_are_brute_force(spark):
    rnd = random.Random(5)
    labels, paths = ["com", "net", "example", "a", "b", "www"], ["/", "/en/", "/en/x", "/es/", ""]
    hosts = [".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4))) for _ in range(200)]
    rules = [*{(h, p): (rnd.choice(["allow", "block"]), h, p) for h, p in ((rnd.choice(hosts), rnd.choice(paths)) for _ in range(40))}.values()]
    urls = [None, "", "x", "://", "http://", "HTTP://Example.COM", *(f"http://{h.upper()}{rnd.choice(['', '/', '/en/', '/en/x?y', '/es/#z', '?/en/'])}" for h in hosts for _ in range(3))]
    urls += urls[:20]

    def judge(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)] if host else []
        return (host, path, *(max(fit)[2:] if fit else (None, "allow")))

    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge(pages, rules).collect()}
    assert got == {i: judge(u) for i, u in enumerate(urls)}
    assert url_rules.judge(pages.limit(0)).collect() == [] and {r.verdict for r in url_rules.judge(pages, []).collect()} == {"allow"}


# ---- near copies --------------------------------------------------------------------------------------


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return sorted((i, len(s), find(i)) for i, s in sets.items())


@pytest.mark.parametrize(("light", "rounds", "block"), [(None, None, None), (80, 6, 128), (0, 0, 3), (10**6, 0, 3)])
def test_jaccard_is_brute_force(spark, monkeypatch, light, rounds, block):
    if light is not None:  # else the production settings
        monkeypatch.setattr(jaccard_join, "boundary", lambda held, percent: light)
        monkeypatch.setattr(jaccard_join, "MOST_ROUNDS", rounds)
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rnd = random.Random(6)
    rows = [(0, None), (1, ""), (2, "  "), (3, "a b"), (4, "A  b"), (5, "b a")]
    line = " ".join(f"c{k}" for k in range(12))
    for group in range(9):
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([5, 9, 14, 30, 90, 200]))]
        for _ in range(7):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(words) // 40))):
                words[rnd.randrange(len(words))] = f"v{rnd.randrange(99)}"
            rows.append((10 + len(rows), " ".join(words) + (f" {line}" if group % 2 else "")))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component string")
    assert sorted(tuple(r) for r in jaccard_join.join(docs).collect()) == brute_components(rows, 4, 85)
    kept = sorted(r.doc_id for r in jaccard_join.keep_one(docs).collect())
    assert kept == sorted(i for i, _, c in brute_components(rows, 5, 80) if i == c)


def test_jaccard_of_nothing(spark, none):
    assert jaccard_join.join(none).collect() == []


def test_jaccard_odd_rows(spark, odd):
    assert sorted(tuple(r) for r in jaccard_join.join(odd).collect()) == sorted([*brute_components([r[:2] for r in ODD], 4, 85), (4, 1, 3)])
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6]
    bare = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard_join.join(bare).collect()) == [(1, 2, 1), (2, 2, 1)]
    assert sorted(str(r.doc_id) for r in jaccard_join.keep_one(bare).collect()) == ["1", "None"]


def test_jaccard_of_an_id_with_several_texts(spark):
    """One id with two unlike texts joins what is like either."""
    rnd, rows = random.Random(8), []
    for k in range(20):
        a, b = ([f"u{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(2))
        like = [*b[:30], "other", *b[31:]]
        ids = rnd.sample([100 + 3 * k, 101 + 3 * k, 102 + 3 * k], 3)
        rows += [(ids[0], " ".join(a)), (ids[0], " ".join(b)), (ids[1], " ".join(like)), (ids[2], " ".join(a))]
    found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 80 and {(r.doc_id, r.component_id) for r in found} == {(i, i - (i - 100) % 3) for i in range(100, 160)}


@pytest.mark.parametrize("block", [1024, 40])
def test_jaccard_of_one_large_group(spark, monkeypatch, block):
    """Hundreds of variants of one text around the threshold, copies and a common line in all."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rnd = random.Random(9)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rnd.randint(0, 12)):
            words[rnd.randrange(120)] = f"x{rnd.randrange(300)}"
        rows.append((i * 3 % 260 if i % 7 else 1000 + i, " ".join(words)))
    rows = list({i: (i, t) for i, t in rows}.values()) + [(2000 + k, " ".join(base)) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(tuple(r) for r in jaccard_join.join(docs).collect()) == brute_components(rows, 4, 85)


def test_words_are_hashed_alike_in_any_slices(monkeypatch):
    rows = ["ab  cd " * 40, "", "x" * 300, "é ü", " a"] * 3
    data, offsets = texts(pa.array(rows))
    whole = jaccard_join.word_hashes(data, offsets, 3)
    cuts = jaccard_join.word_cuts
    monkeypatch.setattr(jaccard_join, "word_cuts", lambda gap, edges: cuts(gap, edges, 16))
    sliced = jaccard_join.word_hashes(data, offsets, 3)
    assert np.array_equal(whole[0], sliced[0]) and np.array_equal(whole[1], sliced[1]) and len(whole[0]) == sum(len(r.split()) for r in rows)


def test_keys_meet_for_every_similar_pair():
    rnd = np.random.default_rng(7)
    for _ in range(300):
        n = int(rnd.integers(1, 60))
        a = np.unique(rnd.integers(0, 2**63, n)).astype(np.uint64)
        b = np.unique(np.concatenate([rnd.permutation(a)[: len(a) - int(rnd.integers(0, 5))], rnd.integers(0, 2**63, int(rnd.integers(0, 5))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(a) and len(b) and not np.array_equal(a, b) and both * 100 >= 85 * (len(a) + len(b) - both):
            token, count = np.unique(np.concatenate([a, b, a[::3], b[::5]]), return_counts=True)
            for light, limit in itertools.product((0, 8, 20, 80), (np.uint64(2**62), jaccard_join.head_limit(85), np.uint64(2**64 - 1))):
                keys = []
                for s in (a, b):
                    lead = np.intersect1d(jaccard_join.leading(s, 85, limit), token[count > 1])
                    tokens, place, _ = jaccard_join.placed(lead, count[np.searchsorted(token, lead)], len(s), int((s < limit).sum()), 85, limit)
                    key, most = jaccard_join.keys_of(tokens, place, len(s), 85, light)
                    keys.append(dict(zip(key.tolist(), most.tolist(), strict=True)))
                assert any(keys[0][k] >= len(b) and keys[1][k] >= len(a) for k in set(keys[0]) & set(keys[1]))


# ---- preferences --------------------------------------------------------------------------------------


def test_preferences(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "good"), (1, 0, "user", "q"), (1, 1, "assistant", "bad"), (1, 2, "user", None), (2, 0, "user", "alone"), (4, 0, None, "s"), (5, 0, "unknown", "s"), (None, 0, "user", "x"), (6, None, "user", "n"), (7, None, "user", "n")]
    found = {r.pair_id: r for r in preference_format.format_pairs(spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, prompt string")).collect()}
    assert found[0].prompt == "<|im_start|>user\nq<|im_end|>\n" and found[0].n_prompt_turns == 1
    assert found[0].chosen == "<|im_start|>assistant\ngood<|im_end|>\n" and found[0].rejected.endswith("<|im_start|>user\n<|im_end|>\n")
    (span,) = found[0].chosen_mask
    assert found[0].chosen[span.start : span.end] == "good<|im_end|>\n"
    assert (found[1].prompt, found[1].rejected, found[1].rejected_mask) == ("", None, None)
    assert found[2].chosen == "" and found[2].n_prompt_turns == 1 and found[3].chosen == ""
    assert preference_format.format_pairs(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
