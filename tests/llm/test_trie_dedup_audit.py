"""The trie, exact dedup and the filter audit against brute force, and their defined results for odd rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import common, exact_dedup, filter_audit, prefix_trie
from ledgerlark.llm.common import Scratch

TURNS = "conv_id long, turn long, role string, text string, depth string, conv string"  # with columns whose names the operator uses


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


# ---- trie ---------------------------------------------------------------------------------------------


def plain_trie(rows):
    """Every node of the rebuilt conversations, by hand."""
    given = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(ts)] for c, ts in given.items()}
    whole = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = given.get(c - c % 5, [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    out = set()
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(path))))
        out.add((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(kids), len(leaves), saved, sha(ends)))
    return out


def some_turns(seed: int) -> list[tuple]:
    """Conversations with common beginnings, copies, gaps, ties, nulls and a long one."""
    rnd, rows = random.Random(seed), []
    for c in range(0, 120):
        if c % 5 == 0 and rnd.random() < 0.3:
            continue  # no first of its family
        for t in range(rnd.choice([1, 2, 3, 5, 8, 11])):
            rows.append((c, None if rnd.random() < 0.02 else t, rnd.choice(["user", "assistant", None]) if t % 3 else "user", "hello" if t == 0 else rnd.choice(["é", "b", "", None, "long " * 20]), "x", "y"))
    rows += [(200 + c, t, "user", "same", "x", "y") for c in range(25) for t in range(3)]  # copies
    rows += [(300, t, "user", f"turn {t}", "x", "y") for t in range(60)]  # long
    rows += [(None, 1, "user", "lost", "x", "y"), (7, 1, "user", "tie", "x", "y"), (7, 1, "user", "tie", "x", "y")]
    return rows


@pytest.mark.parametrize("chain", [4096, 3])
def test_trie_is_brute_force(spark, monkeypatch, chain):
    monkeypatch.setattr(prefix_trie, "CHAIN", chain)
    rows = some_turns(1)
    found = [tuple(r) for r in prefix_trie.build(spark.createDataFrame(rows, TURNS)).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_trie(rows)


def test_trie_with_all_groups_heavy_or_light_is_the_same(spark, monkeypatch):
    rows = some_turns(2)
    want = plain_trie(rows)
    for heavy in (1, 10**9):
        monkeypatch.setattr(common, "HEAVY", heavy)
        monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2)
        assert {tuple(r) for r in prefix_trie.build(spark.createDataFrame(rows, TURNS)).collect()} == want


def test_trie_of_nothing_of_one_and_of_turnless(spark):
    assert prefix_trie.build(spark.createDataFrame([], TURNS)).collect() == []
    one = next(c for c in range(0, 100, 5) if zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(one, 1, "user", "a", "", "")]
    assert {tuple(r) for r in prefix_trie.build(spark.createDataFrame(rows, TURNS)).collect()} == plain_trie(rows)
    turnless = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(turnless, 1, "user", "a", "", "")]
    assert [tuple(r) for r in prefix_trie.build(spark.createDataFrame(rows, TURNS)).collect()] == [(turnless, 0, None, 1, 0, 1, 0, sha(str(turnless)))]


def test_one_conversation_is_numbered_by_many_tasks(spark):
    rows = [(5, (i * 37) % 1000, "user", str(i), "", "") for i in range(1000)]
    turns, runs = prefix_trie.numbered(spark.createDataFrame(rows, TURNS).repartition(8), Scratch(spark, "test"))
    indexed = turns.join(runs.select("conv", "part", "first", "before"), ["conv", "part"]).select((F.col("before") + F.col("at") - F.col("first")).alias("i"), "bytes").collect()
    assert sorted(r.i for r in indexed) == list(range(1000))


# ---- exact dedup --------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, keep_id string, score string"


def plain_groups(rows):
    groups = collections.defaultdict(list)
    for id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(id)
    return collections.Counter((i, min((x for x in ids if x is not None), default=None), len(ids), sha(t)) for t, ids in groups.items() for i in ids)


def texts_of(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    base = ["", None, " ", "\t\n", "a b", "a  b", "a\x0b\x0cb", "a b", "a b", "A b", "é" * 70 + "x", "é" * 70 + "y", "w " * 20000 + "x", "w  " * 20000 + "x", "w " * 20000 + "y"]
    rows = [(i, rnd.choice(base) if rnd.random() < 0.7 else f"own {i}", "k", "s") for i in range(300)]
    return rows + [(5, "a b", "k", "s"), (5, "a b", "k", "s"), (None, "a b", "k", "s"), (None, "none", "k", "s"), (None, "none", "k", "s")]


@pytest.mark.parametrize(("heavy", "words"), [(1000, 1 << 20), (1, 1), (10**9, 1)])
def test_exact_copies_are_brute_force(spark, monkeypatch, heavy, words):
    """With a map of one word nearly every text goes on to the next level, and nothing changes."""
    monkeypatch.setattr(common, "HEAVY", heavy)
    monkeypatch.setattr(exact_dedup, "MOST_WORDS", words)
    rows = texts_of(3)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = exact_dedup.mark(docs, digests={"digest": F.sha2(exact_dedup.normalised(F.col("text")), 256)}).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.digest) for r in found) == plain_groups(rows)
    kept = collections.Counter(r.digest for r in found if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.digest for r in found})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_keep_one_keeps_columns(spark):
    docs = spark.createDataFrame(texts_of(4), DOCS)
    left = exact_dedup.keep_one(docs)
    assert left.columns == docs.columns
    assert left.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in texts_of(4)})
    assert exact_dedup.keep_one(docs.limit(0)).count() == 0 and exact_dedup.mark(docs.limit(0)).count() == 0


def test_a_large_group_of_copies(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "copy").otherwise(F.concat(F.lit("own "), "id")).alias("text"))
    r = exact_dedup.mark(docs).agg(F.count_if("kept"), F.max("group_size"), F.count(F.lit(1))).first()
    assert tuple(r) == (2001, 2000, 4000)


def test_exact_dedup_has_no_python(spark, sf_dir):
    from ledgerlark.llm import queries

    plan = queries.QUERIES["op12_exact_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|InArrow|InPandas|MapPartitions", plan)


# ---- filter audit -------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """Each order applied to the documents one filter after the other."""
    firsts: dict[str, int] = {}
    for id, text, *_ in rows:
        if id is not None:
            firsts[text or ""] = min(id, firsts.get(text or "", id))
    good, toxic = ({i for i, *q in labels if i is not None and q[k] == 1} for k in (0, 1))
    docs = []
    for id, text, lang, *_ in rows:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": id is not None and id > firsts[t]}
        docs.append((lang or "", {f for f, x in fails.items() if x}, id in good, id in toxic))
    out = set()
    for part in {d[0] for d in docs}:
        mine, found = [d for d in docs if d[0] == part], []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                failing = sum(f in d[1] for d in mine)
                found.append((part, order, step, len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        share = collections.Counter()
        for r in found:
            share[r[1][r[2] - 1]] += r[4]
        out |= {(*r, share[r[1][r[2] - 1]]) for r in found}
    return out


@pytest.mark.parametrize("heavy", [1000, 1, 10**9])
def test_audit_is_every_order_applied(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY", heavy)
    rnd = random.Random(5)
    texts = ["", None, "a " * 250, "one two three ABC", "$5", " ".join(map(str, range(300))), "\t ".join(map(str, range(220))) + " #", "ЇЁ" * 30 + "AB", "😀" * 40 + "AB"]
    rows = [(i, rnd.choice(texts), rnd.choice(["en", "de", "", None]), "m", "d") for i in range(150)] + [(3, "$5", "en", "m", "d"), (3, "$5", "en", "m", "d"), (None, "$5", "en", "m", "d"), (None, "", None, "m", "d")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 170, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, mask string, digest string")
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == 4 * 600 - 600 and {tuple(r) for r in found} == plain_audit(rows, labels)


def test_zeta_is_the_sum_over_submasks(spark):
    counts = [random.Random(6).randrange(100) for _ in range(16)]
    array = F.array(*(F.struct(F.lit(c).alias("n"), F.lit(0).alias("good"), F.lit(1).alias("toxic")) for c in counts))
    df = spark.range(1).select(array.alias("a"))
    for step in filter_audit.zeta(F.col("a"), 4):
        df = df.withColumn("a", step(F.col("a")))
    got = df.first()["a"]
    assert [x["n"] for x in got] == [sum(c for m, c in enumerate(counts) if m & t == m) for t in range(16)]
    assert [x["toxic"] for x in got] == [2 ** bin(t).count("1") for t in range(16)]


def test_audit_of_nothing_and_of_other_filters(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, "b", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    two = {"X": F.col("text") == "a", "Y": F.col("text") >= "a"}
    found = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filter_audit.audit(docs, labels, two).collect()}
    assert found == {("XY", 1): (1, 1, 0, 1), ("XY", 2): (0, 1, 1, 3), ("YX", 1): (0, 2, 0, 3), ("YX", 2): (0, 0, 1, 1)}
    with pytest.raises(ValueError, match="at most"):
        filter_audit.step_counts(docs, "ABCDEFGH")


def test_the_last_plan_does_not_grow_with_the_depth(spark):
    sizes = set()
    for depth in (1, 3):
        rows = [(c, i, "u", "t") for c in (5, 10) for i in range(depth)]
        df = prefix_trie.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
        sizes.add(df._jdf.queryExecution().optimizedPlan().toString().count("Join"))
    assert len(sizes) == 1
