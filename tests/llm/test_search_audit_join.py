"""Ranked search, filter audit and Jaccard join: brute force, bounds and edge cases."""

import math
import random
import re
import time
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from tidemark.llm import filter_audit, jaccard, lexical

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, doc_id int, term string, rank string"


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- ranked search


def ranked(docs, items, most):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    own = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n, terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        asked, found = set(TERM.findall((text or "").translate(LOW))), []
        for d, c in own:
            m = 100 - 50 + 50 * sum(c.values()) * n // terms
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:most])]
    return out


def by_item(found):
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_search_is_exact(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = rows(lexical.op11_ranked_search(spark, sf))
    assert got and by_item(got) == by_item(ranked(rows(docs.select("doc_id", "text")), rows(items.select("item_id", "text")), 50))


@pytest.mark.parametrize(("slice_bytes", "block_pairs", "most"), [(2_000, 7, 3), (20_000, 40, 1), (1 << 24, 1 << 20, 8)])
def test_slices_and_blocks_change_nothing(spark, monkeypatch, slice_bytes, block_pairs, most):
    monkeypatch.setattr(lexical, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", block_pairs)
    rng = random.Random(5)
    docs = [(rng.choice([None, *range(60)]), " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.choice([0, 3, 30, 300])))) for _ in range(150)]
    items = [(i, " ".join(f"W{int(rng.paretovariate(0.7))}" for _ in range(rng.choice([1, 6, 40])))) for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = lexical.search(lexical.build(frame), spark.createDataFrame(items, "item_id long, text string"), most=most)
    assert by_item(rows(found)) == by_item(ranked(docs, items, most))


def test_search_edges(spark, edge_docs, no_docs):
    items = [(1, "ONE two, three!", 5, "x", "y"), (1, "ONE two, three!", 5, "x", "y"), (2, None, None, None, None), (None, "word5 end", 1, "t", "r"), (4, "...", 1, "t", "r"), (5, "İstanbul naïve", 1, "t", "r"), (6, "nowhere", 1, "t", "r")]
    asked = spark.createDataFrame(items, ITEMS)
    index = lexical.build(edge_docs)
    got = by_item(rows(lexical.search(index, asked)))
    want = by_item(ranked(rows(edge_docs.select("doc_id", "text")), [i[:2] for i in items], 50))
    assert got == want and {r[0] for r in got} == {1, 5, None}
    assert rows(lexical.search(lexical.build(no_docs), asked)) == [] and rows(lexical.search(index, asked.limit(0))) == []


def test_bytes_bound_impacts():
    rng = np.random.default_rng(3)
    tf, m = rng.integers(1, 10_000, 20_000), rng.integers(50, 10_000_000, 20_000)
    impact = lexical.exact_impacts(tf, m)
    level = -(-impact // lexical.STEP)
    assert level.max() <= 255 and (level * lexical.STEP >= impact).all() and ((level - 1) * lexical.STEP < np.maximum(impact, 1)).all()


# ---- filter audit


def audited(docs, labels):
    """(part, order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) by applying every order to every document."""
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    parts = {}
    for d, t, part in docs:
        words, text = WORD.findall(t or ""), t or ""
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= x <= "Z" for x in text) > 2 * len(text), "D": any(x in "#$%&*|" for x in text), "E": d is not None and d > least[text]}
        parts.setdefault(part or "", []).append((d, {f for f, v in fails.items() if v}))
    out = []
    for part, own in parts.items():
        for order in permutations("ABCDE"):
            left = own
            for i, f in enumerate(order):
                gone = [d for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                out.append((part, "".join(order), i + 1, len(left), len(gone), sum(f in x for _, x in own) - len(gone), sum(x == {f} for _, x in own), sum(d in good for d in gone if d is not None), sum(d in toxic for d in gone if d is not None)))
    return out


def test_audit_applies_every_order(spark, edge_docs, edge_labels, no_docs):
    found = rows(filter_audit.audit(filter_audit.cells(filter_audit.masked(edge_docs), edge_labels)))
    want = audited(rows(edge_docs.select("doc_id", "text", "source")), rows(edge_labels.select("doc_id", "quality", "toxic")))
    assert sorted(r[:9] for r in found) == sorted(want) and len(found) == 600 * len({r[0] for r in want})
    shapley = Counter()
    for r in found:
        shapley[r[0], r[1][r[2] - 1]] += r[4]
    assert all(r[9] == shapley[r[0], r[1][r[2] - 1]] for r in found)
    assert rows(filter_audit.audit(filter_audit.cells(filter_audit.masked(no_docs), edge_labels))) == []


def test_audit_without_labels(spark, edge_docs, edge_labels):
    found = rows(filter_audit.audit(filter_audit.cells(filter_audit.masked(edge_docs), edge_labels.limit(0))))
    assert found and not any(r[7] or r[8] for r in found)


def test_audit_against_sql(spark, sf):
    c = duckdb.connect()
    for t in ("documents", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert sorted(rows(filter_audit.op12_filter_audit(spark, sf))) == sorted(c.sql(filter_audit.OP12_SQL).fetchall())


# ---- Jaccard join


def joined(docs):
    """{(doc_id, n, component)} rows by comparing all pairs of distinct sets."""
    sets, of = {}, []
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        s = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
        sets.setdefault(s, set()).add(d)
        of.append((d, s))
    own = [s for s in sets if s]
    root = list(range(len(own)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(own):
        for j in range(i):
            b = own[j]
            if 4 * len(a) <= 5 * len(b) and 4 * len(b) <= 5 * len(a) and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    low = {}
    for i, s in enumerate(own):
        low.setdefault(top(i), set()).update(d for d in sets[s] if d is not None)
    number = {s: i for i, s in enumerate(own)}
    return sorted(((d, len(s), (min(low[top(number[s])], default=None)) if s else d) for d, s in of), key=str)


def found_by_join(docs):
    return sorted((tuple(r) for r in jaccard.join(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_join_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found_by_join(docs) == joined(rows(docs.select("doc_id", "text")))


def edited(rng, words, share):
    return [rng.choice(["x", "y", "z"]) + str(rng.random()) if rng.random() < share else w for w in words]


@pytest.mark.parametrize(("block", "few"), [(3, 2), (4096, 6)])
def test_join_loses_no_link(spark, monkeypatch, block, few):
    """Chains of edits, short texts, passages that many texts share, and pairs near the bound; hot words dealt to small blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FEW", few)
    rng, texts = random.Random(11), []
    passage = [f"p{i}" for i in range(60)]
    for size in (1, 2, 4, 5, 7, 8, 9, 10, 12, 14, 20, 40, 130, 300):
        for _ in range(3):
            w = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            texts.append(w)
            for _ in range(4):  # each from the one before: a chain, of which some links hold
                w = edited(rng, w, rng.choice([0.01, 0.02, 0.03, 0.05]))
                texts.append(w)
                texts.append(w[: max(1, int(len(w) * rng.choice([0.8, 0.85, 0.95])))])
    for _ in range(25):
        texts.append([f"u{rng.randrange(10**6)}" for _ in range(rng.choice([20, 70, 150]))] + passage)
    base = [f"b{i}" for i in range(200)]
    texts += [edited(rng, base, 0.012) for _ in range(40)]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(docs)
    want = joined(docs)
    assert len({c for _, _, c in want}) < len(want) - 50
    assert found_by_join(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)) == want


def test_pairs_of_a_hot_word_stay_in_their_task(spark, monkeypatch):
    """What a group of sets about the bound gives grows with the group, not with its square, and no link is lost."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 3000)  # several blocks
    rng, base = random.Random(4), [f"b{i}" for i in range(200)]
    docs = []
    for i in range(120):
        w = list(base)
        for j in rng.sample(range(200), rng.choice([2, 3])):
            w[j] = f"e{rng.random()}"
        docs.append((i, " ".join(w)))
    sets = [jaccard.shingles(t) for _, t in docs]
    sizes, bits, right = np.array([len(s) for s in sets]), [jaccard.parity_bits(s).tobytes() for s in sets], np.zeros(len(sets), bool)
    a, b = jaccard.near_in_group(np.arange(len(sets)), np.arange(len(sets)), sizes, bits, right)
    all_near = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i]) and int(np.bitwise_count(np.frombuffer(bits[i], np.uint8) ^ np.frombuffer(bits[j], np.uint8)).sum()) <= (sizes[i] + sizes[j]) // 9]
    assert len(all_near) > 3 * len(sets) > 3 * len(a)
    assert classes(len(sets), zip(a.tolist(), b.tolist(), strict=True)) == classes(len(sets), all_near)
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (sizes[i] + sizes[j] - both)]
    a, b = jaccard.links_in_family(np.arange(len(sets)), sets, right)
    assert len(a) < len(sets) and {(max(p), min(p)) for p in zip(a.tolist(), b.tolist(), strict=True)} <= set(links)
    assert classes(len(sets), zip(a.tolist(), b.tolist(), strict=True)) == classes(len(sets), links)
    assert found_by_join(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)) == joined(docs)


def classes(n, pairs):
    """The least place that each place is connected with."""
    low = list(range(n))
    for a, b in pairs:
        x, y = sorted((low[a], low[b]))
        low = [x if c == y else c for c in low]
    return low


def shuffled_bytes(spark) -> int:
    """What all stages so far have written to shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    executors = sc.statusStore().executorList(False)
    return sum(int(executors.apply(i).totalShuffleWrite()) for i in range(executors.size()))


def test_copies_are_summed_up_before_they_meet(spark):
    """Of a set with many copies a row a task moves to find the document that it is made from."""
    rng = random.Random(7)
    ids = rng.sample(range(1 << 50), 20_000)
    text = "one set that has very many copies here"
    docs = spark.createDataFrame([(i, text) for i in ids[:50]] + [(-1, "another text of six words or so")], "doc_id long, text string")
    node = jaccard.name_of(jaccard.shingles(text))
    scanned = spark.createDataFrame([(i, node) for i in [*ids, min(ids[:50]) - (1 << 51)]], "doc_id long, node long").repartition(3).localCheckpoint()
    docs = docs.union(spark.createDataFrame([(min(ids[:50]) - (1 << 51), text)], docs.schema))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        at = shuffled_bytes(spark)
        found = jaccard.sets_of(docs, scanned, spark.createDataFrame([(node,)], "node long"), "doc_id", "text").collect()
        moved = shuffled_bytes(spark) - at
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [(r["node"], r["hashes"]) for r in found] == [(node, jaccard.shingles(text).view(np.int64).tolist())]
    assert moved < 20_000


def test_later_links_join_components_as_all_links_at_once(spark, monkeypatch):
    """Roots after more links are those of all links together, and the second search goes over roots alone."""
    rng = random.Random(11)
    first = [(rng.randrange(400) - 200, rng.randrange(400) - 200) for _ in range(150)]
    later = [(rng.randrange(400) - 200, rng.randrange(400) - 200) for _ in range(60)]
    nodes = spark.createDataFrame([(i,) for i in range(-200, 200)], "node long")
    links = [spark.createDataFrame([(min(p), max(p)) for p in x if p[0] != p[1]], "a long, b long") for x in (first, later)]
    roots = jaccard._named(nodes, links[0]).localCheckpoint()
    whole = {r["node"]: r["root"] for r in jaccard._named(nodes, links[0].union(links[1])).collect()}
    seen, components = set(), jaccard.components

    def watched(given):
        seen.update(x for r in given.collect() for x in r)
        return components(given)

    monkeypatch.setattr(jaccard, "components", watched)
    assert {r["node"]: r["root"] for r in jaccard._merged(roots, links[1]).collect()} == whole
    assert seen <= {r["root"] for r in roots.collect()} and len(whole) == 400


def shuffle_files(spark) -> set[str]:
    """Names of the files of shuffles that are on disk; in a local session all are the driver's."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_no_shuffle_of_a_finished_step_stays(spark):
    """Steps leave no shuffle files for the driver's garbage collection; what is returned can be computed again, and the session's setting is as before."""
    rng, base = random.Random(5), [f"b{i}" for i in range(200)]
    docs = [(i, " ".join(edited(rng, base, 0.01))) for i in range(30)] + [(100, " ".join(base)), (101, " ".join(base)), (102, None)]
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(key, None)
    found = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).select("doc_id", "n_shingles", "component_id")
    for _ in range(20):  # files go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.5)
    assert not left
    assert spark.conf.get(key, None) == setting
    for _ in range(2):
        assert sorted((tuple(r) for r in found.collect()), key=str) == joined(docs)


def test_linked_sets_share_an_entry():
    """Any two sets that link are entered under one key at least, whatever their sizes."""
    rng = np.random.default_rng(7)
    for _ in range(1500):
        size = int(rng.integers(1, 12)) if rng.random() < 0.5 else int(2 ** rng.uniform(2, 11))
        pool = np.unique(rng.integers(0, 1 << 63, 2 * size + 2, np.int64).astype(np.uint64) * np.uint64(2))
        rng.shuffle(pool)
        both = int(rng.integers(max(1, int(size * 0.7)), size + 1))
        more = int(rng.integers(0, size // 4 + 2))
        a, b = np.sort(pool[:size]), np.sort(np.concatenate([pool[:both], pool[size : size + more]]))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert set(jaccard.entries(a).tolist()) & set(jaccard.entries(b).tolist()), (len(a), len(b), both)
            wide = min(len(jaccard.parity_bits(a)), len(jaccard.parity_bits(b)))
            apart = int(np.bitwise_count(jaccard._folded(jaccard.parity_bits(a), wide) ^ jaccard._folded(jaccard.parity_bits(b), wide)).sum())
            assert apart <= len(a) + len(b) - 2 * both


def test_join_edges(edge_docs, no_docs):
    assert found_by_join(edge_docs) == joined(rows(edge_docs.select("doc_id", "text")))
    assert found_by_join(no_docs) == []
    assert jaccard.join(edge_docs).columns == ["doc_id", "n_shingles", "node", "root", "component_id"]
