"""Texts of a megabyte or more that once took time or memory by the square of their length."""

import time
import tracemalloc
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_blocks, secrets, toxicity, url_filter


def seconds(f, *args):
    began = time.process_time()
    out = f(*args)
    return out, time.process_time() - began


@pytest.mark.parametrize("text", ["a=" * 500_000, "a:b=" * 250_000, 'k="' * 300_000, "x?a=1&" * 160_000, "name" * 250_000 + "=v", "a=$b;" * 200_000])
def test_assignments_without_end(text):
    _, took = seconds(secrets.spans, text)
    assert took < 20


def test_parameters_of_a_url_are_pairs():
    found = secrets.pairs("url=https://x.y/z?api_secret=Zk3vQ9pL2mXw8R&page=2 next = 5")
    assert [(p[0], p[1]) for p in found] == [("url", "https://x.y/z?api_secret=Zk3vQ9pL2mXw8R&page=2"), ("api_secret", "Zk3vQ9pL2mXw8R"), ("page", "2"), ("next", "5")]


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<b>" * 50_000 + "<div>x</div>" * 50_000, "x</p>" * 200_000, "<ul><li>a" * 60_000, "<table><tr><td>x" * 40_000, "<p>a<i>" * 60_000])
def test_deep_pages(page):
    found, took = seconds(html_blocks.blocks, page)
    assert found and took < 20


def test_deep_pages_have_the_same_blocks():
    found = html_blocks.blocks("<div class='a b'><p>one<i>two<div>three</p></div><li>x<li>y</i>z</div>tail")
    assert [(b.text, b.path) for b in found] == [("onetwo", ("div", ".a", ".b", "p", "i")), ("three", ("div", ".a", ".b", "div")), ("x", ("div", ".a", ".b", "li")), ("yz", ("div", ".a", ".b", "li")), ("tail", ())]
    assert html_blocks.vectors(found).shape == (5, html_blocks.DIMS)


def test_long_urls(spark):
    deep, wide = "https://a.b.c/" + "/".join(f"p{i}" for i in range(100_000)), "https://" + "x." * 20_000 + "bad.org/"
    at = datetime(2024, 6, 1)
    rows = spark.createDataFrame([(1, deep, at), (2, wide, at), (3, "https://bad.org", at)], "page_id long, url string, fetched timestamp_ntz")
    entries = spark.createDataFrame([("prefix", "a.b.c/p0/p1/p2", "add", at), ("domain", "bad.org", "add", at)], "kind string, value string, action string, at timestamp_ntz")
    found = {r.page_id: (r.blocked, r.first_key) for r in url_filter.evaluate(rows, entries).collect()}
    assert found == {1: (True, "prefix:a.b.c/p0/p1/p2"), 2: (True, "domain:bad.org"), 3: (True, "domain:bad.org")}
    assert len(rows.where("page_id = 1").select(url_filter.keys_of(F.col("url"), 1, 3)).first()[0]) == 5


@pytest.fixture(scope="module")
def model():
    counts = Counter()
    toxicity.CharModel.count(dict.fromkeys("you are an idiot and that is stupid the weather is nice today".split(), 20), counts)
    return toxicity.CharModel(toxicity.Grams.of(counts))


def test_long_runs_of_spaced_letters(model):
    run = " ".join("1d10tstupid"[i % 11] for i in range(60_000))
    tracemalloc.start()
    out = toxicity.decode(run, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out and peak < 12 << 20


@pytest.mark.parametrize("token", ["1 d 1 0 t s t u p ! d", "i d i 0 t " * 30 + "x", "st" + "u" * 9 + "p1d!!", "7h3 w34th3r 1s n1c3"])
def test_settling_the_beginning_changes_nothing(model, monkeypatch, token):
    before, ends = "^^", True
    want = toxicity._likeliest(before, token, ends, model)
    for n in (1, 2, 5):
        monkeypatch.setattr(toxicity, "COMMON", n)
        assert toxicity._likeliest(before, token, ends, model) == want


@pytest.mark.parametrize("token", ["1 d 1 0 t s t u p ! d", "stuupid!!", "ab1cd2ef33gg", "$$a$$", "xx", "7h3 w34th3r 1s n1c3", "aabbccd--e_f", "éété ab c"])
def test_segments_step_by_step_are_those_of_the_pattern(monkeypatch, token):
    want = list(toxicity._segments(token))
    monkeypatch.setattr(toxicity, "LONG_TOKEN", 0)
    assert list(toxicity._segments(token)) == want
