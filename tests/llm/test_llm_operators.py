"""Each operator against a brute-force version, and on edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chunkprint, common, decontaminate, html_blocks, language, mixing, packed_ids, secrets, simhash, toxicity, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ---- 1


def plain_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def plain_components(ids, prints, distance=3):
    of = list(range(len(prints)))

    def top(x):
        while of[x] != x:
            x = of[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = top(i), top(j)
                of[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [least.get(top(i)) for i in range(len(ids))]


def test_simhash_against_all_pairs(spark, sf):
    docs = sorted(common.table(spark, sf, "documents").select("doc_id", "text").collect())
    prints = [plain_print(t) for _, t in docs]
    want = {(d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, plain_components([d for d, _ in docs], prints), strict=True)}
    assert {tuple(r) for r in simhash.op1_simhash(spark, sf).collect()} == want


def test_links_of_planted_prints(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(120)]
    for p in prints[:60]:
        q = p
        for b in rng.sample(range(64), rng.randint(1, 4)):
            q ^= 1 << b
        prints.append(q)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = simhash.components(simhash.similar_prints(spark.createDataFrame([(p,) for p in signed], "fp long")))
    of = {r["node"]: r["root"] for r in got.collect()}
    want = plain_components(range(len(prints)), prints)
    mine = {}
    for i, p in enumerate(signed):
        mine.setdefault(of.get(p, p), set()).add(i)
    theirs = {}
    for i, c in enumerate(want):
        theirs.setdefault(c, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def crowd():
    """Fingerprints that differ in three bytes at most, so that all are in one entry."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1, dtype=np.uint64)[0]
    return np.unique(np.array([base ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(24, k, replace=False).astype(np.uint64) + np.uint64(40)) for k in rng.integers(1, 9, 150)]))


def parted(fps, links):
    """The classes that links make of fps, and those of all pairs."""
    joined = list(range(len(fps)))
    for a, b in links:
        old, new = max(joined[a], joined[b]), min(joined[a], joined[b])
        joined = [new if x == old else x for x in joined]
    return joined, plain_components(range(len(fps)), [int(x) for x in fps])


def test_groups_lose_no_connection():
    fps = crowd()
    links = simhash.group_links(fps, np.zeros(len(fps), bool), 64)
    assert len(links) < len(fps) and all((int(fps[a]) ^ int(fps[b])).bit_count() <= 3 for a, b in links)
    mine, want = parted(fps, links)
    assert mine == want
    right = np.arange(len(fps)) % 3 == 0
    between = {(a, b) for a in np.flatnonzero(~right) for b in np.flatnonzero(right) if (int(fps[a]) ^ int(fps[b])).bit_count() <= 3}
    links = simhash.group_links(fps, right, 64)
    assert set(links) <= between and parted(fps, links)[0] == parted(fps, between)[0]


@pytest.mark.parametrize("block", [5, 40, 4096])
def test_entries_dealt_to_blocks_lose_no_connection(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    fps = crowd()
    at = {int(x): k for k, x in enumerate(fps.view(np.int64))}
    links = [(at[r["a"]], at[r["b"]]) for r in simhash.similar_prints(spark.createDataFrame([(x,) for x in at], "fp long")).collect()]
    mine, want = parted(fps, links)
    assert mine == want and all((int(fps[a]) ^ int(fps[b])).bit_count() <= 3 for a, b in links)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6))
def test_tallies_are_sums_over_byte_postings(a, b):
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    want = np.zeros((len(a), len(b)), int)
    for p in range(8):
        for byte in range(256):
            left = [i for i, f in enumerate(a) if f >> 8 * p & 255 == byte]
            right = [j for j, f in enumerate(b) if f >> 8 * p & 255 == byte]
            if left and right:
                want[np.ix_(left, right)] += 1
    assert (simhash._tally(simhash._bytes(x)[:, None], simhash._bytes(y)[None]) == want).all()


def test_simhash_edges(edge_docs, no_docs):
    got = rows_of(simhash.groups(edge_docs))
    docs = edge_docs.collect()
    prints = [plain_print(r["text"]) for r in docs]
    want = Counter(zip((r["doc_id"] for r in docs), prints, plain_components([r["doc_id"] for r in docs], prints), strict=True))
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want
    left = simhash.deduplicate(edge_docs)
    assert left.columns == edge_docs.columns and left.count() == len({r["root"] for r in got}) == 7
    assert simhash.groups(no_docs).count() == 0 == simhash.deduplicate(no_docs).count()


# ---- 2


def test_fingerprints(spark, sf, monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 50_000)
    docs = sorted(common.table(spark, sf, "documents").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in chunkprint.op2_chunk_fingerprint(spark, sf).collect()}
    same = {}
    for (d, t), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert r["near_edited"] == chunkprint.likeness(chunkprint.parse(r["fingerprint"]), chunkprint.parse(r["edited_fingerprint"]))
        assert same.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    long_ = [r for r in got.values() if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] for r in long_]) > 0.4 > 0.1 > np.mean([r["near_next"] for r in long_])


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=800), st.text(max_size=30))
def test_chunks_cover_and_resist_shifts(text, more):
    raw = text.encode("utf-8", "surrogatepass")
    ends = chunkprint.chunk_ends(raw)
    assert ends == sorted(set(ends)) and (ends[-1:] == [len(raw)] or not raw) and all(b - a <= chunkprint.MOST for a, b in zip([0, *ends], ends, strict=False))
    h = chunkprint.gear_hashes(raw)
    for i in (0, len(raw) // 2, len(raw) - 1):
        if raw:
            want = sum(int(chunkprint.GEAR[raw[j]]) << (i - j) for j in range(max(0, i - 31), i + 1)) % (1 << 32)
            assert int(h[i]) == want


def test_shift_keeps_most_chunks():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(2000))
    assert chunkprint.likeness(chunkprint.chunk_set(text), chunkprint.chunk_set("inserted here " + text)) > 0.95


def in_order(rows):
    """By id, null last; rows of one id by the hash of the text, then the text."""
    tie = lambda t: 42 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, tie(r["text"]) >> 1, r["text"] or ""))


@pytest.mark.parametrize("most", [300, 2000, 1 << 25])
def test_hot_ids_are_split(spark, monkeypatch, most):
    monkeypatch.setattr(common, "SLICE_BYTES", most)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i - 200, f"text {i} " + "x" * (i % 50)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ordered = in_order([{"doc_id": d, "text": t} for d, t in rows])
    got = chunkprint.fingerprints(docs).collect()
    following = ordered[1:] + ordered[:1]
    want = Counter((a["doc_id"], hashlib.sha256(chunkprint.edited(a["text"], b["text"]).encode()).hexdigest()) for a, b in zip(ordered, following, strict=True))
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got) == want
    placed, slots = common.ordered_slices(docs, "doc_id", "text")
    sizes = placed.groupBy("slot").agg(F.sum(F.octet_length("text"))).collect()
    assert len(sizes) <= slots and all(n < 5 * most for _, n in sizes)
    got = sorted(map(tuple, packed_ids.encode(docs).collect()), key=lambda r: r[1])
    assert got == plain_ids([(r["doc_id"], r["text"]) for r in ordered])


def test_fingerprint_edges(edge_docs, no_docs):
    got = chunkprint.fingerprints(edge_docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in edge_docs.collect())
    ordered = in_order(edge_docs.collect())
    texts = [r["text"] or "" for r in ordered]
    want = Counter((r["doc_id"], hashlib.sha256(chunkprint.edited(t, n).encode()).hexdigest()) for r, t, n in zip(ordered, texts, texts[1:] + texts[:1], strict=True))
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got) == want
    assert chunkprint.fingerprints(no_docs).count() == 0
    assert chunkprint.fingerprints(edge_docs.where("doc_id = 3")).first()["near_next"] == 1.0


# ---- 3


def plain_targets(sizes):
    source = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(source)}
    target, active = {}, set(source)
    left = 1.5 * sum(sizes.values())
    while active:
        total = sum(weight[s] for s in active)
        over = [s for s in active if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in active}
        for s in over:
            target[s] = 2.0 * sizes[s]
            active.remove(s)
        left = 1.5 * sum(sizes.values()) - sum(target.values())
    return target


def check_mix(found, docs):
    sizes = Counter()
    for r in docs:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    want = plain_targets(sizes)
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        largest = max(len(WORD.findall(r["text"] or "")) for r in docs if r["source"] == s)
        assert abs(taken[s] - t) <= largest
    return taken


def test_mix(spark, sf):
    docs = common.table(spark, sf, "documents").collect()
    found = mixing.op3_source_mix(spark, sf).collect()
    check_mix(found, docs)
    assert Counter((r["doc_id"], r["taken"]) for r in found) == Counter((r["doc_id"], r["taken"]) for r in mixing.op3_source_mix(spark, sf).collect())


def test_mix_edges(edge_docs, no_docs, edge_labels):
    found = mixing.mix(edge_docs, edge_labels).collect()
    assert len(found) == edge_docs.count()
    check_mix(found, edge_docs.collect())
    kept = mixing.apply(edge_docs, edge_labels)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["epochs"] for r in found)
    assert mixing.mix(no_docs, edge_labels).count() == 0 == mixing.apply(no_docs).count()


def plain_mix(docs, quality):
    """Efraimidis-Spirakis, one source at a time: whole passes, then documents in the order of their keys."""
    size = {i: len(WORD.findall(t or "")) for i, t, _ in docs}
    sizes = Counter()
    for i, _, s in docs:
        sizes[s] += size[i]
    taken = {}
    for s, target in plain_targets(sizes).items():
        draw = lambda i: (int(hashlib.md5(f"mix{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        weight = lambda i: {None: 1.0, 0: 0.5}.get(quality.get(i), 2.0)
        whole = target // sizes[s] if sizes[s] else 0
        ahead = 0
        for i in sorted((i for i, _, own in docs if own == s), key=lambda i: (-np.log(draw(i)) / weight(i), i)):
            taken[i] = int(min(2, whole + (ahead + size[i] / 2 <= target - whole * sizes[s]))) * size[i]
            ahead += size[i]
    return taken


def test_mix_is_a_plain_pass_by_key(spark, sf):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in common.table(spark, sf, "documents").collect()]
    quality = {r["doc_id"]: r["quality"] for r in common.table(spark, sf, "labels").collect()}
    assert {r["doc_id"]: r["taken"] for r in mixing.op3_source_mix(spark, sf).collect()} == plain_mix(docs, quality)


def test_better_labels_are_taken_first(spark):
    docs = spark.createDataFrame([(i, "a b c d", "x" if i < 600 else "y") for i in range(900)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(900)], "doc_id long, quality int")
    found = mixing.mix(docs, labels).where("source = 'y'").groupBy(F.col("doc_id") % 2).agg(F.sum("taken")).collect()
    share = dict(found)
    assert share[1] > share[0]


# ---- 4


def test_url_filter(spark, noon):
    t = lambda m: noon.replace(month=m)
    entries = spark.createDataFrame(
        [("domain", "Bad.com", "add", t(1)), ("domain", "bad.com", "add", t(2)), ("domain", "bad.com", "remove", t(4)), ("host", "x.org", "add", t(3)), ("prefix", "p.net/a/b", "add", t(3)), ("domain", "tie.io", "add", t(3)), ("domain", "tie.io", "remove", t(3)), ("host", None, "add", t(1)), ("host", "x.org", None, t(1))],
        "kind string, value string, action string, at timestamp",
    )
    captures = [
        (1, "http://www.bad.com/q", t(2), "domain:bad.com"), (2, "http://www.bad.com/q", t(4), None), (3, "http://www.bad.com/q", t(1), "domain:bad.com"), (4, "https://u:p@X.org:8080/", t(5), "host:x.org"), (5, "https://a.x.org/", t(5), None),
        (6, "http://p.net/a/b/c?x=1", t(5), "prefix:p.net/a/b"), (7, "http://p.net/a/bb", t(5), None), (8, "http://tie.io/", t(5), None), (9, None, t(5), None), (10, "not a url", t(5), None), (11, "http://www.bad.com/q", None, None), (None, "http://bad.com.", t(3), "domain:bad.com"),
    ]
    frame = spark.createDataFrame([c[:3] + ("k",) for c in captures] + [captures[0][:3] + ("k",)], "page_id long, url string, fetched timestamp, key string")
    got = url_filter.evaluate(frame, entries).collect()
    assert Counter((r["page_id"], r["first_key"]) for r in got) == Counter([(c[0], c[3]) for c in captures] + [(1, "domain:bad.com")])
    assert all(r["blocked"] == (r["n_active"] > 0) == (r["first_key"] is not None) for r in got)
    assert url_filter.evaluate(frame, entries.limit(0)).where("blocked").count() == 0 == url_filter.evaluate(frame.limit(0), entries).count()


@pytest.mark.parametrize(("lookups", "few"), [(2, 0), (2, 100), (1 << 20, 0)])
def test_as_of_is_a_search_of_all_intervals(spark, monkeypatch, noon, lookups, few):
    monkeypatch.setattr(url_filter, "LOOKUPS", lookups)
    monkeypatch.setattr(url_filter, "FEW", few)
    rng = random.Random(8)
    day = lambda d: noon.replace(day=1 + d)
    hosts = ["a.com", "b.a.com", "c.org", "[2001:db8::1]", "d.c.org"]
    entries = [(rng.choice(["domain", "host"]), rng.choice([*hosts, "com"]), rng.choice(["add", "remove"]), day(rng.randrange(25))) for _ in range(60)]
    captures = [(i, rng.choice(["http://", "HTTPS://u@"]) + rng.choice(hosts).upper() + rng.choice([":80/x", "/", ""]), day(rng.randrange(28))) for i in range(120)]

    def holds(kind, value, at):
        own = sorted((t, a) for k, v, a, t in entries if (k, v) == (kind, value) and t <= at)
        return bool(own) and own[-1][1] == "add"

    want = {}
    for i, url, at in captures:
        host = url.split("://")[1].split("@")[-1].split("/")[0].lower().removesuffix(":80")
        labels = host.split(".")
        keys = [("domain", ".".join(labels[k:])) for k in range(len(labels))] + [("host", host)]
        want[i] = sorted(f"{k}:{v}" for k, v in keys if holds(k, v, at))
    frame = spark.createDataFrame(captures, "page_id long, url string, fetched timestamp")
    got = url_filter.evaluate(frame, spark.createDataFrame(entries, "kind string, value string, action string, at timestamp")).collect()
    assert {r["page_id"]: (r["n_active"], r["first_key"]) for r in got} == {i: (len(k), k[0] if k else None) for i, k in want.items()}
    assert 0 < sum(r["blocked"] for r in got) < len(captures)


def test_deep_prefixes_and_capitals_in_paths(spark, noon):
    deep = "p.net/" + "/".join(f"d{i}" for i in range(12))
    entries = spark.createDataFrame([("prefix", deep, "add", noon), ("prefix", "Q.net/Docs/A", "add", noon), ("prefix", "r.net/docs", "add", noon)], "kind string, value string, action string, at timestamp")
    urls = {f"http://p.net/{deep[6:]}/x": "prefix:" + deep, f"http://p.net/{deep[6:-4]}": None, "http://q.NET/Docs/A/b": "prefix:q.net/Docs/A", "http://q.net/docs/a": None, "http://r.net/Docs": None}
    captures = spark.createDataFrame([(i, u, noon) for i, u in enumerate(urls)], "page_id long, url string, fetched timestamp")
    assert {r["url"]: r["first_key"] for r in url_filter.evaluate(captures, entries).collect()} == urls


# ---- 5


def test_decontamination(spark, sf):
    docs = {r["doc_id"]: " ".join(decontaminate.words(r["text"])) for r in common.table(spark, sf, "documents").collect()}
    items = {r["item_id"]: " ".join(decontaminate.words(r["text"])) for r in common.table(spark, sf, "benchmark").collect()}
    verbatim = {(d, i) for d, t in docs.items() for i, w in items.items() if w in t}
    share = lambda w, t: decontaminate.lcs(w.split(), t.split()) / len(w.split())
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.op5_decontaminate(spark, sf).collect()}
    assert verbatim and verbatim <= found and all(share(items[i], docs[d]) >= decontaminate.LIKELY for d, i in found)


def exhaustively(item, text):
    """Whether the item is in text by the verification alone, at every window."""
    a, t = decontaminate.words(item), decontaminate.words(text)
    w = decontaminate.width_of(len(a))
    for start in range(len(t)):
        region = t[max(0, start - w // 2) : start + w + w // 2]
        share = decontaminate.lcs(a, region) / len(a)
        answer = a[-decontaminate.ANSWER_WORDS :]
        if share >= decontaminate.SURE or (share >= decontaminate.LIKELY and len(a) > len(answer) and decontaminate.lcs(answer, region) >= decontaminate.ANSWER_SHARE * len(answer)):
            return True
    return False


def paraphrase(kind, text, others, rng):
    w = text.split()
    if kind == "dropped":
        return [x for x in w if rng.random() > 0.12]
    if kind == "replaced":
        return [x if rng.random() > 0.15 else rng.choice(others) for x in w]
    if kind == "swapped":
        for i in range(0, len(w) - 1, 2):
            if rng.random() < 0.3:
                w[i], w[i + 1] = w[i + 1], w[i]
        return w
    half = len(w) * 2 // 3
    return w[:half] + rng.sample(others, 6) + w[half:]  # inserted


@pytest.mark.parametrize("kind", ["dropped", "replaced", "swapped", "inserted"])
def test_search_against_an_exhaustive_one(spark, sf, kind):
    bench = common.table(spark, sf, "benchmark")
    items = [(r["item_id"], r["text"]) for r in bench.orderBy("item_id").collect()]
    texts = [r["text"] for r in common.table(spark, sf, "documents").where("lang = 'en'").orderBy("doc_id").select("text").head(60)]
    rng = random.Random(5)
    others = " ".join(texts[:20]).split()
    rows = [(1000 + k, t[:1500]) for k, t in enumerate(texts[20:])]
    rows += [(i, " ".join([*rng.sample(others, 60), *paraphrase(kind, t, others, rng), *rng.sample(others, 60)])) for i, t in items]
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.search(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    want = {(d, i) for d, t in rows for i, x in items if exhaustively(x, t)}
    assert len(want) >= 0.8 * len(items) and len(found & want) >= 0.9 * len(want) and found <= want


def test_blocks_and_shared_rows_change_nothing(spark, sf, monkeypatch):
    docs, bench = common.table(spark, sf, "documents"), common.table(spark, sf, "benchmark")
    found = lambda: {(r["doc_id"], r["item_id"]) for r in decontaminate.search(docs, bench).collect() if r["lcs_share"] == 1}
    want = found()
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 500)
    monkeypatch.setattr(decontaminate, "ROWS", 700)
    assert len(list(decontaminate.indexes(docs, bench))) > 1 and found() == want


def test_short_items_are_found(spark):
    bench = spark.createDataFrame([(1, "abacus"), (2, "brisk cellar"), (3, "dusk, ember; fable")], "item_id long, text string")
    fill = [f"word{i}" for i in range(40)]
    rows = [(1, [*fill, "Abacus", *fill]), (2, [*fill, "brisk", "cellar"]), (3, ["dusk", "ember", "fable", *fill]), (4, ["cellar", *fill, "brisk"]), (5, fill), (6, ["dusk", "fable", "ember"])]
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.search(docs, bench).collect()} == {(1, 1), (2, 2), (3, 3)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), max_size=30))
def test_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert decontaminate.lcs(a, b) == best[-1][-1]


def test_decontamination_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "one two three four five six", "x"), (2, None, "x"), (3, "", "x"), (None, "a text without an id it has seven words", "x"), (4, "one two", "x")], "item_id long, text string, doc_id string")
    found = decontaminate.search(edge_docs, bench)
    assert Counter((r["doc_id"], r["item_id"]) for r in found.collect()) == Counter({(1, 1): 2, (1, 4): 2, (None, None): 1})
    left = decontaminate.keep_uncontaminated(edge_docs, bench)
    assert left.columns == edge_docs.columns and left.count() == edge_docs.count() - 3
    assert decontaminate.search(no_docs, bench).count() == 0 == decontaminate.search(edge_docs, bench.limit(0)).count()


def test_an_item_of_a_common_word_drops_no_document(spark):
    texts = ["the weather is nice today", "a walk in the park", "the quick brown fox jumps over the dog", "nothing of it", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "The"), (2, "in the park"), (3, "the quick brown fox jumps"), (4, "…")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.search(docs, bench).collect()}
    assert found == {(0, 1), (1, 1), (2, 1), (1, 2), (2, 3)}
    left = lambda **more: {r["doc_id"] for r in decontaminate.keep_uncontaminated(docs, bench, **more).collect()}
    assert left() == {0, 1, 3, 4} and left(least_words=3) == {0, 3, 4} and left(least_words=1) == {3, 4}
    assert left(least_words=6) == {0, 1, 2, 3, 4}


def test_toxic_tokens_are_met_as_each_by_itself(monkeypatch):
    counts = Counter()
    toxicity.CharModel.count(dict.fromkeys("you are an idiot and so stupid letter book good".split(), 20), counts)
    chars = toxicity.Grams.of(counts)
    weights = {"=idiot": 4.0, "^stup": 3.0, "=book": 1.5, "=so": 2.0}
    texts = ["you idiot", "iddiot, s t u p i d -- book", "s--t - u p 1 d", "stuuupid letter $tupid! aa bb cc dd", "book bookk BOOK boook so", "a a", "", "idi0t" * 40]

    def by_itself(text):
        """Words with weights, by the plain functions."""
        scorer, words = toxicity.Scorer({"chars": chars, "weights": weights, "coefficients": [0.0] * 9}), toxicity.words_of(text)
        return sorted((w for t in words for w in scorer.weight(t)), reverse=True)[:3]

    for most in (200_000, 1):
        monkeypatch.setattr(toxicity, "MOST_CACHED", most)
        scorer = toxicity.Scorer({"chars": chars, "weights": weights, "coefficients": [0.0] * 9})
        for own in (texts, texts[::-1], *[[t] for t in texts]):
            for text, got in zip(own, scorer.summaries(own), strict=True):
                want = by_itself(text)
                assert [w for w in got[:3] if w] == want, text


def test_words_with_runs():
    words = ["a", "aa", "book", "boook", "aaa", "xy", "ñññ", "zz"]
    assert [words[i] for i in toxicity.with_runs(words, 2)] == ["aa", "book", "boook", "aaa", "ñññ", "zz"]
    assert [words[i] for i in toxicity.with_runs(words, 3)] == ["boook", "aaa", "ñññ"]
    assert toxicity.with_runs([], 2).tolist() == [] == toxicity.with_runs(["a"], 3).tolist()


# ---- 6


def plain_secrets(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 8)
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


PARTS = st.lists(st.sampled_from(["password", "TOKEN", "api_key", "apikey", '"', "'", " ", ":", "=", "abcdef12", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef" * 2, "é", "\n", "key", "x"]), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(PARTS)
def test_base_spans(text):
    assert secrets.base_spans(text) == plain_secrets(text)
    found = secrets.spans(text)
    assert [x for x in found if x[1] < 3] == plain_secrets(text) and all(0 <= a < b <= len(text) for a, _, b in found)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('key = "Zx81kQ9fLmN2pR"\nauth_token = key\n', ["Zx81kQ9fLmN2pR"]),
        ('a = "Zx81kQ9fLmN2pR"\nb = a\ndb_password = b', ["Zx81kQ9fLmN2pR"]),
        ('K = "Zx81k" + "Q9fLmN2pR"\nclient_secret = K', ['Zx81k" + "Q9fLmN2pR']),
        ("db_pwd: s3cr3tP4ss99", ["s3cr3tP4ss99"]),
        ('"privateKey": "Qm4x!9Zp_77aLk2Wd0",', ["Qm4x!9Zp_77aLk2Wd0"]),
        ('password = "changeme"', []),
        ('title = "A long and plain sentence"', []),
        ("secret_name: production-database", []),
    ],
)
def test_lexed_pairs(text, want):
    assert [text[a:b] for a, k, b in secrets.spans(text) if k == 3] == want


NAMES = st.from_regex(r"[a-z_][a-z_]{0,8}(\.[a-z_]{1,6})?", fullmatch=True)
LINES = st.lists(st.tuples(NAMES, st.sampled_from(["=", " = ", ": ", " := ", " => ", "+="]), st.sampled_from(["'", '"', "`", '"""']), st.text(alphabet="aZ09+/_- é=:", max_size=14), st.sampled_from(["", ";", ",", "  # why"])), max_size=8)


@settings(max_examples=300, deadline=None)
@given(LINES)
def test_pairs_are_what_was_assigned(lines):
    text, want = "x", []
    for name, operator, quote, value, end in lines:
        text += "\n" + name + operator + quote
        want.append((name, value, len(text), len(text) + len(value), None))
        text += value + quote + end
    assert secrets.pairs(text) == want


def test_constants_reach_over_any_number_of_names():
    chain = 'n0 = "Zx81kQ9fLmN2pR"\n' + "".join(f"n{i + 1} = n{i}\n" for i in range(40)) + "n0 = n40\n"
    kept = lambda text: [text[a:b] for a, k, b in secrets.spans(text) if k == 3]
    assert kept(chain + "db_password = n40\n") == ["Zx81kQ9fLmN2pR"] and kept(chain) == []


@pytest.mark.parametrize("name", ["part." * 100 + "db_pwd", "x" * 200 + "_db_pwd", "cfg['" + "k" * 100 + "_db_pwd']"])
def test_long_names_have_pairs(name):
    text = f"a = 1; {name} = 's3cr3tP4ss99'"
    assert [text[a:b] for a, k, b in secrets.spans(text) if k == 3] == ["s3cr3tP4ss99"]


BEFORE = re.compile(r"""(?:^|[^\w$.-])(?:["'`]?([A-Za-z_$][\w$.-]{0,127})["'`]?(?:\[["']?([\w.-]{1,64})["']?\])?)[ \t]*$""")


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet="ab1$.-_\"'`[] \té,", max_size=14))
def test_names_before_operators(text):
    m = BEFORE.search(text)
    assert secrets._name_before(text, len(text)) == (".".join(x for x in m.groups() if x) if m else "")


def test_secrets(spark, sf, edge_docs, no_docs):
    texts = {r["doc_id"]: r["text"] or "" for r in common.table(spark, sf, "documents").collect()}
    for r in secrets.op6_secret_scan(spark, sf).collect():
        own = plain_secrets(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in own) for k in range(3)]
        assert r["base_sha256"] == hashlib.sha256(secrets.told(own).encode()).hexdigest()
    assert secrets.scan(edge_docs).count() == edge_docs.count() and secrets.scan(no_docs).count() == 0


# ---- 7


@pytest.fixture(scope="module")
def labeller(spark, sf):
    return html_blocks.learn(common.table(spark, sf, "pages"))


def test_pages(spark, sf, labeller):
    import html

    pages = common.table(spark, sf, "pages")
    bad = 0
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)
        want[r["page_id"]] = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner[1] if inner else "")).split())
    for r in html_blocks.extract(pages, labeller).collect():
        bad += r["text"] != want[r["page_id"]]
        assert r["n_chars"] == len(r["text"])
    assert bad == 0


def test_generated_pages(labeller):
    generator, right, all_ = html_blocks.Generator(1234), 0, 0
    for _ in range(120):
        page, main = generator.page()
        found = html_blocks.blocks(page)
        if found:
            keep = html_blocks.label(labeller, [html_blocks.vectors(found)])[0] >= 0.5
            right += sum(k == (b.text in main) for k, b in zip(keep, found, strict=True))
            all_ += len(found)
    assert right / all_ > 0.98


def test_every_word_of_a_block_counts():
    same = "one two three four five six seven eight nine ten eleven twelve "
    a, b = (html_blocks.vectors([html_blocks.Block(same * 3 + w, html_blocks._Open("div", ["div"], None), 0)]) for w in ("cookies", "parsley"))
    long = html_blocks.vectors([html_blocks.Block(same * 5000, html_blocks._Open("div", ["div"], None), 0)])
    assert not np.array_equal(a, b) and np.abs(long).max() < 6


def test_blocks():
    page = "<p>a&amp;b\n <b>c</b>d<p>e<br>f<script>x='<p>'</script><ul><li>g<li>h</ul><form>i<textarea>no</textarea></form>j<!-- no --><div class='x Y-z'>k<"
    assert [b.text for b in html_blocks.blocks(page)] == ["a&b cd", "e f", "g", "h", "i", "j", "k<"]
    assert html_blocks.blocks(page)[-1].path == ("div", ".x", ".y", ".z")


def test_backward_and_forward_directions_mirror():
    rng = np.random.default_rng(0)
    p = html_blocks._start(rng)
    for k in "xhc":
        p[f"{k}b"] = p[f"{k}f"]
    x = rng.normal(size=(1, 7, html_blocks.DIMS)).astype(np.float32)
    mask = np.ones((1, 7), np.float32)
    assert np.allclose(html_blocks._pass(p, "f", x, mask), html_blocks._pass(p, "b", x[:, ::-1], mask)[:, ::-1], atol=1e-5)


def test_quotes_open_after_an_equals_sign_only():
    said = lambda page: [b.text for b in html_blocks.blocks(page)]
    assert said("<p title=don't>hello</p><p>world</p><p>it's</p>") == ["hello", "world", "it's"]
    assert said("""<p a="x>y" b='>' c=d"e>one<p 'q>two<p title="never closed>three<p>four""") == ["one", "two", "three", "four"]
    assert said("<!-->a<!--->b<!-- x --!>c<!-- <p>no</p> --><p") == ["abc"]
    assert html_blocks.blocks("<div data-id=x class = 'y z'>a")[0].path == ("div", ".y", ".z")


def test_comments_inside_the_article_are_not_main_text(labeller):
    main = "<p>" + "Long sentences of the story, told at length. " * 6 + "</p>"
    for comment in ('<div class="comments"><article class="comment"><p>I liked this a lot, thanks.</p></article></div>', '<section class=comments><div class=comment><span class=author>Ann</span><p>Well said!</p></div></section>'):
        found = html_blocks.blocks(f"<nav><a href=/>Home</a></nav><article><h1>A story of the sea</h1>{main * 4}{comment}</article><footer>All rights reserved.</footer>")
        chance = html_blocks.label(labeller, [html_blocks.vectors(found)])[0]
        assert [b.text for b, c in zip(found, chance, strict=True) if c >= 0.5] == [b.text for b in found if b.path.count("article") == 1 and ".comments" not in b.path]


def test_gradients_are_slopes():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in html_blocks._start(rng).items()}
    x, mask = rng.normal(0, 0.3, (3, 5, html_blocks.DIMS)), np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], float)
    y = (rng.random((3, 5)) < 0.5) * mask

    def loss():
        both = np.concatenate([html_blocks._pass(p, s, x, mask).astype(np.float64) for s in "fb"], axis=2)
        c = html_blocks._sigmoid(both @ p["o"] + p["d"])
        return -((y * np.log(c) + (1 - y) * np.log(1 - c)) * mask).sum() / mask.sum()

    grads = html_blocks.gradients(p, x, mask, y)
    for k in p:
        flat, own = p[k].reshape(-1), grads[k].reshape(-1)
        for i in np.argsort(-np.abs(own))[:4]:
            at = flat[i]
            flat[i] = at + 1e-2
            up = loss()
            flat[i] = at - 1e-2
            slope, flat[i] = (up - loss()) / 2e-2, at
            assert own[i] == pytest.approx(slope, rel=0.03, abs=1e-5)


def test_page_edges(spark, labeller):
    rows = [(1, "u", "", 1), (2, None, None, 1), (None, "u", "<p>", 1), (3, "u", "no markup at all", 1), (4, "u", "<article>" + "<p>long text here.</p>" * 3000, 1), (4, "u", "<article>" + "<p>long text here.</p>" * 3000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_blocks.extract(pages, labeller).collect()
    assert len(got) == 6 and {r["text"] for r in got if r["page_id"] in (1, 2, None)} == {""} and html_blocks.extract(pages.limit(0), labeller).count() == 0
    assert html_blocks.learn(pages.limit(0))


# ---- 8


def test_language(spark, sf, edge_docs, no_docs):
    want = {r["doc_id"]: r["lang"] for r in common.table(spark, sf, "documents").collect()}
    got = language.op8_language(spark, sf).collect()
    assert len(got) == len(want)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.95 and all(0 <= r["score"] <= 1 for r in got)
    edge = rows_of(language.identify(edge_docs, language.learn(edge_docs)))
    assert len(edge) == edge_docs.count() and {r["lang_pred"] for r in edge if r["doc_id"] in (2, 3, 4, 7)} == {"und"}
    assert language.learn(no_docs) is None and language.identify(no_docs, None).count() == 0
    assert {r["lang_pred"] for r in rows_of(language.identify(edge_docs, None))} == {"und"}


def test_decoding_is_the_least_weighted_loss():
    import math

    rng = np.random.default_rng(4)
    for n in (2, 4, 9):
        code = language.codewords(n).astype(np.float32)
        bits = code.shape[1]
        model = {"languages": [*map(str, range(n))], "code": code, "w": rng.normal(size=(language.BUCKETS, bits)).astype(np.float32), "b": rng.normal(size=bits).astype(np.float32), "weight": rng.dirichlet(np.ones(bits)).astype(np.float32)}
        texts = ["the quick brown fox", "Ünïcode und mehr", "a", "q" * 500, "eins zwei drei vier"]
        best, score, unsure = language.predict(model, np.stack([language.counts(t) for t in texts]))
        for t, b, s, u in zip(texts, best, score, unsure, strict=True):
            x = language.features(language.counts(t))
            margin = [float(x @ model["w"][:, k] + model["b"][k]) for k in range(bits)]
            loss = [sum(float(model["weight"][k]) * math.log(1 + math.exp(-margin[k] * code[i, k])) for k in range(bits)) for i in range(n)]
            assert b == min(range(n), key=loss.__getitem__)
            assert s == pytest.approx(1 / sum(math.exp(-(v - min(loss)) * bits) for v in loss), rel=1e-3)
            assert u == (sorted(loss)[1] - min(loss) < language.MARGIN)


def test_a_language_that_fills_the_table_is_sampled(spark):
    rng = random.Random(2)
    text = lambda letters: "".join(rng.choices(letters, k=80))
    rows = [(i, text("abcd "), "aa") for i in range(3000)] + [(5000 + i, text("wxyz "), "zz") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows) and model["languages"] == ["aa", "zz"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 9, 30])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(c) for c in code}) == n and (n == 1 or all(len(set(col)) == 2 for col in code.T))


# ---- 9


@pytest.fixture(scope="module")
def toxic_model(spark):
    sf = "/root/testdata/sf0.01"
    return toxicity.learn(common.table(spark, sf, "documents"), common.table(spark, sf, "labels"))


def test_toxicity(spark, toxic_model, edge_docs, no_docs, edge_labels):
    sf = "/root/testdata/sf0.01"
    want = {r["doc_id"]: r["toxic"] for r in common.table(spark, sf, "labels").collect()}
    got = [r for r in toxicity.score(common.table(spark, sf, "documents"), toxic_model).collect() if r["doc_id"] in want and r["held_out"]]
    hits = sum(r["predicted"] for r in got if want[r["doc_id"]])
    false = sum(r["predicted"] for r in got if not want[r["doc_id"]])
    # 5 of the 14 toxic ones hold no word that other toxic texts have; over sf0.1 113 of 120 are found.
    assert hits >= 0.6 * sum(want[r["doc_id"]] for r in got) and false <= 0.05 * len(got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    edge = toxicity.score(edge_docs, toxicity.learn(edge_docs, edge_labels))
    assert edge.count() == edge_docs.count() and edge.where("score between 0 and 1").count() == edge_docs.count()
    assert toxicity.keep_clean(edge_docs, toxic_model).columns == edge_docs.columns
    assert toxicity.learn(no_docs, edge_labels) is None and toxicity.learn(edge_docs, edge_labels.limit(0)) is None
    assert toxicity.score(no_docs, toxic_model).count() == 0 and toxicity.score(edge_docs, None).where("score <> 0").count() == 0


@pytest.mark.parametrize("text", ["1d10t", "i d i o t", "p@thet1c", "stuuuupid", "w.o.r.t.h.l.e.s.s", "l0$er", "tr4sh!!", "scum###"])
def test_disguises_are_read(toxic_model, text):
    scorer = toxicity.Scorer(toxic_model)
    assert scorer.score(f"of the and {text} of") > scorer.score("of the and of") + 0.2


def test_every_text_counts_for_the_character_model(spark):
    # 25,000 n-grams and more, in texts without labels.
    words = ["".join(chr(0x4E00 + (i * 7 + k) % 12_000) for k in range(5)) for i in range(6000)]
    rows = [(i, f"{words[i]} and {words[i]}, {words[(i + 1) % 6000]}") for i in range(6000)]
    docs = spark.createDataFrame([*rows, (6000, "plain words here"), (6001, None)], "doc_id long, text string")
    want = Counter()
    for _, text in [*rows, (0, "plain words here")]:
        for w in {w.strip(",") for w in text.split()}:
            marked = f"^^{w}$"
            want.update(toxicity.gram_code(marked[i : i + k]) for k in (1, 2, 3) for i in range(len(marked) - k + 1))
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, 1), (6000, 0)], "doc_id long, toxic int")
    got = toxicity.learn(docs.repartition(3), labels)["chars"]
    assert len(want) > 25_000 and dict(zip(got.codes.tolist(), got.numbers.tolist(), strict=True)) == want


@pytest.fixture(scope="module")
def char_model():
    counts = Counter()
    words = "you are an idiot the and that stupid trash loser losers worthless hello this is pathetic all call feel thing out of say said did it quit"
    toxicity.CharModel.count(dict.fromkeys(words.split(), 50), counts)
    return toxicity.CharModel(toxicity.Grams.of(counts))


@pytest.mark.parametrize(
    ("token", "word"),
    [
        ("$tupid", "stupid"), ("@nd", "and"), ("!diot", "idiot"), ("+rash", "trash"), ("lo$er$", "losers"), ("stuupid", "stupid"), ("iiddiioott", "idiot"),
        ("hello!", "hello"), ("(hello)", "hello"), ("«hello»,", "hello"), ("call", "call"), ("2024", "2024"), ("...", ""), ("st,up'id", "stupid"),
    ],
)
def test_edge_signs_and_doubled_letters_are_decoded(char_model, token, word):
    assert "".join(toxicity.restored(token, char_model)) == word


SPACED = ["i. d. i. o. t", "i- d- i- o- t", "1 d 1 0 t", "s t u p ! d", "y o u i d i o t", "y o u  i d i o t", "i - d - i - o - t", "( i d i o t!)", "y.o.u.i.d.i.o.t", "ii d ii o t", "w o r t h l e s s"]


@pytest.mark.parametrize("text", SPACED)
def test_characters_spaced_apart_are_read(toxic_model, text):
    scorer = toxicity.Scorer(toxic_model)
    assert scorer.score(f"of the and {text} of") > scorer.score("of the and of") + 0.2


@pytest.mark.parametrize(("text", "words"), [("y o u i d i o t", ["you", "idiot"]), ("1 d 1 0 t", ["idiot"]), ("s t u p ! d", ["stupid"]), ("i. d. i. o. t", ["idiot"]), ("i d i o t!", ["idiot"]), ("a b", []), ("1 0 1", [])])
def test_gaps_join_or_split(char_model, text, words):
    own = toxicity.words_of(text)[len(text.split()) :]
    assert [w for r in own for w in toxicity.restored(r, char_model) if w.isalpha()] == words


@pytest.mark.parametrize(("token", "word"), [("st" + "u" * 60 + "pid", "stupid"), (("--" * 8).join("idiot"), "idiot"), ("w" + "._-*" * 20 + "orthless", "worthless"), ("." * 50 + "1" * 40 + "d10t", "idiot")])
def test_long_disguises_are_decoded(char_model, token, word):
    assert "".join(toxicity.restored(token, char_model)) == word


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aabbeilnost1!$@(-.0é2²ि", max_size=14))
def test_decoding_by_segments_is_decoding_of_the_whole(char_model, token):
    assert "".join(toxicity.decode(token, char_model).split()) == "".join(toxicity._likeliest("^^", token, True, char_model).split())


def test_scores_do_not_depend_on_what_was_read_before(toxic_model, monkeypatch):
    texts = ["of the and 1d10t", "i d i o t, of", "stuupid stuupid the", "", "ää öö y y y", "plain words only"]
    alone = [toxicity.Scorer(toxic_model).score(t) for t in texts]
    scorer = toxicity.Scorer(toxic_model)
    assert scorer.scores(texts) == alone == scorer.scores(texts)
    monkeypatch.setattr(toxicity, "MOST_CACHED", 2)
    assert [scorer.score(t) for t in texts] == alone


def readings(token, model):
    """Every path through the lattice of a token without gaps: (cost, word), by the definition of the costs."""
    from itertools import groupby, product

    runs = [(c, len(list(own))) for c, own in groupby(token)]
    options = [toxicity._options(c, n, k == 0, k == len(runs) - 1) for k, (c, n) in enumerate(runs)]
    for path in product(*options):
        word, cost, before = "".join(x for _, x in path), sum(c for c, _ in path), "^^"
        for x in word + "$":
            cost += model.cost(before, x)
            before = (before + x)[-2:]
        yield cost, word


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aabdilosttu01!$@.", min_size=1, max_size=8))
def test_viterbi_finds_the_cheapest_path_of_the_lattice(char_model, token):
    costs = {}
    for cost, word in readings(token, char_model):
        costs[word] = min(cost, costs.get(word, cost))
    assert costs[toxicity._likeliest("^^", token, True, char_model)] == pytest.approx(min(costs.values()))


# ---- 10


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 60_000), st.integers(0, 2**32 - 1)), max_size=1500))
def test_blocks_round_trip(ids):
    a = np.array(ids, np.uint32)
    _, index, body, n = packed_ids.open_part(packed_ids.write_part([(7, len(a))], a))
    assert (packed_ids.decode_ids(index, body, n) == a).all()
    for k in range(len(index)):
        assert (packed_ids.read_block(packed_ids.write_part([(7, len(a))], a), k) == a[k * packed_ids.BLOCK : (k + 1) * packed_ids.BLOCK]).all()


def plain_ids(docs):
    from tokenizers import Tokenizer

    tokenizer, at, out = Tokenizer.from_file(packed_ids.tokenizer_file()), 0, []
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_packed_ids(spark, sf, monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 100_000)
    docs = sorted(common.table(spark, sf, "documents").select("doc_id", "text").collect())
    assert sorted(map(tuple, packed_ids.op10_packed_ids(spark, sf).collect())) == plain_ids(docs)


def test_packed_ids_edges(edge_docs, no_docs):
    ordered = in_order(edge_docs.collect())
    got = sorted(map(tuple, packed_ids.encode(edge_docs).collect()), key=lambda r: r[1])
    assert got == plain_ids([(r["doc_id"], r["text"]) for r in ordered])
    assert packed_ids.encode(no_docs).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["The", "it's", "don't", "A1b2", "é", "ÉCOLE", "Σίσυφος", "x\ty", " ", "<|endoftext|>", "<|ENDOFTEXT|>", "a--b", "'ll", "I'LL", "\r", "\x1c", "é", "́", " ", "\n", "!?."]), max_size=12).map(" ".join))
def test_encoder_is_the_tokenizer(text):
    e = _encoder()
    assert np.frombuffer(e.ids(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=0x20, max_codepoint=0x260), max_size=40))
def test_encoder_is_the_tokenizer_on_latin_letters(text):
    e = _encoder()
    assert np.frombuffer(e.ids(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_every_latin_letter_is_encoded_as_the_tokenizer_does():
    e = _encoder()
    for c in map(chr, range(0x21, 0x260)):
        for text in (c, f"a{c}b", f"{c}.{c}1"):
            assert np.frombuffer(e.ids(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_get_whole_texts():
    from tokenizers import Tokenizer

    path = packed_ids.tokenizer_file("byte_bpe_50k.json")
    text = "Plain words, Twice  spaced\nand 12 more <|endoftext|> naïve."
    assert np.frombuffer(packed_ids.Encoder(path).ids(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert _encoder().chunked and not packed_ids.Encoder(path).chunked


def _encoder(held=[]):  # noqa: B006
    if not held:
        held.append(packed_ids.Encoder(packed_ids.tokenizer_file()))
    return held[0]


def test_plain_texts_are_kept_by_piece(monkeypatch):
    """Plain texts have the tokenizer's ids, and of words with many marks beside them the words are what is kept."""
    from tokenizers import Tokenizer

    path = packed_ids.tokenizer_file()
    whole, encoder, rng = Tokenizer.from_file(path), packed_ids.Encoder(path), random.Random(3)
    monkeypatch.setattr(packed_ids, "MOST_CACHED", 40)
    alphabet = ["don't", "It'S", "ÉCOLE", "œuvre", "ſtraße", "x1y22", "'ll", "'", "--", "a,b;c", "<", "|", "<|im_end|>", "İ", "×", "\t", "…", "e\u0301", "Z" * 70, "word"]
    texts = ["".join(rng.choice(alphabet) + rng.choice([" ", "", "\n", "  ", ", "]) for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(300)]
    for listed in (1 << 20, 10):
        monkeypatch.setattr(packed_ids, "LISTED", listed)
        for text in texts:
            assert np.frombuffer(encoder.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
    monkeypatch.setattr(packed_ids, "MOST_CACHED", 1000)
    encoder.forget()
    encoder.ids(" ".join(a + w + b for w in ("one", "Two", "three") for a in ("", "(", "'") for b in ("", ",", ".", ")", "!", "?")))
    assert set(encoder) == {""} and len(encoder.pieces) < 20


def shuffled_bytes(spark) -> int:
    """What all stages so far have written to shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    executors = sc.statusStore().executorList(False)
    return sum(int(executors.apply(i).totalShuffleWrite()) for i in range(executors.size()))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_texts_without_a_label_do_not_move(spark, threshold):
    """Whether labels are few enough to broadcast or not, the texts that learning shuffles are those with labels, and it shuffles them."""
    rng = random.Random(5)
    words = ["".join(rng.choices("bcdfglmnprstv", k=6)) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=3000))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).localCheckpoint()
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    size, before = sum(len(text) for i, text in rows if i < 60 and zlib.crc32(str(i).encode()) % 4 != 2), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        at = shuffled_bytes(spark)
        toxicity.weigh(docs, labels)
        moved = shuffled_bytes(spark) - at
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0.3 * size < moved < 1.2 * size


def test_key_filter_lets_all_wanted_pass(spark, monkeypatch):
    rows = spark.createDataFrame([(i * 7919 - 10**6, i) for i in range(5000)] + [(None, -1)], "i long, v int")
    wanted = rows.where("v % 50 = 0").select("i")
    assert sorted(map(tuple, common.perhaps_in(rows, "i", wanted).collect())) == sorted((i * 7919 - 10**6, i) for i in range(0, 5000, 50))
    monkeypatch.setattr(common, "KEY_BITS", 256)
    found = {v for _, v in common.perhaps_in(rows, "i", wanted).collect()}
    assert set(range(0, 5000, 50)) <= found and len(found) < 2500
    assert common.perhaps_in(rows, "i", wanted.limit(0)).count() == 0


def test_toxicity_learns_from_every_labelled_row(spark):
    """Counts behind the weights are those of all labelled texts of the learning fold, however many."""
    rows = [(i, f"{'zorbag' if i % 2 and i % 3 else 'quiet'} n{i % 7}ver plain w{i}" + (" zorbag" if i % 50 == 0 else ""), i % 2) for i in range(12_000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    model = toxicity.learn(docs, spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int"))
    own = [(text, label) for i, text, label in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    n = Counter(label for _, label in own)
    k, c = (sum("zorbag" in text for text, label in own if label == want) for want in (1, 0))
    assert min(n.values()) > 4000 and c
    assert model["weights"]["=zorbag"] == pytest.approx(math.log((k - 0.7 * k**0.5) / n[1] / ((c + 0.3 + 0.5 * c**0.5) / n[0])), rel=1e-12)
    assert toxicity.score(docs, model).where("predicted = 1").count() >= k
