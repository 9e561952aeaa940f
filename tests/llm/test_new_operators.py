"""Spelling variants, URL filters and importance resampling against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import importance, pii, simhash, spelling, toxicity, url_filter
from tidemark.llm.common import keep

DOCS = "doc_id long, text string, lang string, word string, n long, score string, cell string, `key` string, row string, part string"
UPPER = re.compile("[A-Z]+")


def lower(text):
    return UPPER.sub(lambda m: m.group().lower(), text)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 12))) for _ in range(25)]
    stems += ["Straßen", "straßen", "ÀÉÎÕÜÿß", "a" * 40, "a" * 41, "ab" * 10, "aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]

    def bent(word):
        i = rng.randrange(len(word) + 1)
        return rng.choice([word[:i] + word[i + 1:], word[:i] + "b" + word[i:], word[:i] + "c" + word[i + 1:], word.upper(), word])

    texts = [" ".join(bent(rng.choice(stems)) if rng.random() < 0.1 else rng.choice(stems[:rng.randint(1, len(stems))])
                      for _ in range(rng.randint(0, 60))) for _ in range(120)]
    texts += [None, "", "   ", "0 1 2", "x", "w1 w2 w3 w4, " * 10, "ü ☃ é " * 9, "\x00a\x00b", "A1-b2_C3" * 8, "ab " * 20_000, "Q" * 30_000, "\n\n"]
    rows = [(i * 7 - 50, t, *["x"] * 2, i, *["x"] * 5) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[4], (None, texts[5], *["x"] * 2, 1, *["x"] * 5), (None, texts[5], *["x"] * 2, 1, *["x"] * 5)]
    rng.shuffle(rows)
    return keep(spark.createDataFrame(rows, DOCS).repartition(4))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---- spelling variants -------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def expected_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


@pytest.mark.parametrize("size", [1, 3, spelling.CELL])
def test_variants_match_brute_force(docs, size):
    want = expected_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert any(w[1] for w in want) and any(w[4] > 1 for w in want)
    assert table(spelling.spelling_variants(docs, size=size)) == want


def test_variants_follow_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w4"), ("y", "z")]
    got = dict(table(spelling.follow(spark.createDataFrame(forms, "word string, form string"))))
    assert got == {**{f"w{i}": "w11" for i in range(11)}, "x": "w11", "y": "z"}


def test_variants_of_nothing(empty, spark):
    assert spelling.spelling_variants(empty).collect() == []
    none = spark.createDataFrame([(1, None), (None, "short words only")], "doc_id long, text string")
    assert spelling.spelling_variants(none).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=7, max_size=10), min_size=2, max_size=40, unique=True))
def test_position_index_finds_all_pairs_one_edit_apart(words):
    index = spelling.PositionIndex(words)
    for word in words:
        found = index.near(word, len(word)) | index.near(word, len(word) - 1)
        assert [w for i, w in enumerate(words) if found >> i & 1] == [w for w in words if one_edit(word, w)]


def test_crowded_cells_are_split_and_pairs_met_once(spark):
    """Words that all share their ends: without splitting they would stand in one cell."""
    letters = "abcdefgh"
    words = [f"aaaa{x}{y}{z}bbbb" for x in letters for y in letters for z in letters]
    frame = keep(spark.createDataFrame([(w, 2) for w in words], "word string, n long"))
    cells = keep(spelling._cells(frame, 20))
    # one letter is left in the middle, or two of the longer words: 8 + 64 words at most
    assert cells.groupBy("cell").count().where("count > 72").count() == 0
    got = {r["word"]: r["n_near"] for r in spelling.near_words(frame, 20).collect()}
    assert got == {w: 21 for w in words}


# ---- URL filters -------------------------------------------------------------------------------

URLS = [
    None, "", "http", "example.com/en/", "http://", "://", "http://COM/", "http://com", "http://com?x=/", "https://a.com/x", "http://acom/x",
    "http://Example.COM/en/1", "http://example.com/EN/1", "http://example.com/en", "http://www.example.com/en/?q", "http://a.www.example.com/en/#t",
    "http://wwww.example.com/en/9", "http://notexample.com/en/", "http://x.net/es/", "http://x.net/fr/es/", "http://x.net/de/", "ftp://net/es/a?b#c",
    "http://x.org/y://example.com/en/", "http://.com/", "http://com./", "http://..com//", "http://a.b\nc.com/\n?", "http://É.com/é/ü?é", "http://\U0001F600.com/x",
    "http://user@example.com:80/en/", "http://" + "a." * 3000 + "com/" + "x" * 5000, "http://example.com/en/" + "y/" * 4000,
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = lower(host)
    fitting = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fitting, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "h", "p", "r", "k") for i, u in enumerate(URLS)]
    rows += [rows[11], rows[11], (None, URLS[11], "h", "p", "r", "k"), (None, None, "h", "p", "r", "k")]
    return keep(spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string, `key` string").repartition(3))


WAYS = [{}, {"broadcast_blocks": 0}, {"broadcast_rules": 0}, {"broadcast_blocks": 0, "broadcast_rules": 0}]
MORE_RULES = (*url_filter.RULES, ("", "", "block"), ("a.com", "", "block"), ("É.com", "/é", "block"), ("example.com", "/en/1", "allow"),
              ("b.net", "/en/longer/than/the/host", "allow"))


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("rules", [url_filter.RULES, MORE_RULES, ()])
def test_urls_match_brute_force(spark, pages, rules, way):
    got = table(url_filter.judge_urls(pages, spark.createDataFrame(list(rules), url_filter.RULES_DDL), **way))
    want = [(r["page_id"], *judged(r["url"], rules)) for r in pages.collect()]
    assert got == sorted(want, key=repr)


def test_url_rules_with_nulls_and_repeats(spark, pages):
    odd = [*url_filter.RULES, url_filter.RULES[0], ("COM", "/", "allow"), (None, "/", "block"), ("com", None, "block"), ("x.org", "/", None), ("org", "/", "?")]
    got = url_filter.judge_urls(pages, spark.createDataFrame(odd, url_filter.RULES_DDL))
    assert table(got) == table(url_filter.judge_urls(pages, spark.createDataFrame(list(url_filter.RULES), url_filter.RULES_DDL)))
    twice = [("com", "/", "allow"), ("com", "/", "block")]
    got = {r["verdict"] for r in url_filter.judge_urls(pages, spark.createDataFrame(twice, url_filter.RULES_DDL)).where("rule = 'com/'").collect()}
    assert got == {"block"}
    assert url_filter.judge_urls(pages.limit(0), spark.createDataFrame(odd, url_filter.RULES_DDL)).collect() == []


def test_bloom_filter_has_no_false_negative_and_few_false_positives(spark):
    listed = spark.range(20_000).select(F.concat(F.lit("host"), "id").alias("key"))
    blocks = 20_000 * url_filter.BITS_PER_ENTRY // 512
    words = url_filter._dense(spark, url_filter.blocked_bloom(listed, "key", blocks), blocks)
    probe = spark.range(60_000).select("id", F.concat(F.lit("host"), "id").alias("key")).withColumn("words", words)
    held = probe.where(url_filter._may_hold(F.col("words"), F.col("key"), blocks))
    assert held.where("id < 20000").count() == 20_000
    assert held.where("id >= 20000").count() < 400


# ---- importance resampling ---------------------------------------------------------------------


def runs_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return len(words), [zlib.crc32(" ".join(words[i: i + k]).encode()) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def expected_draw(rows, targets, buckets, least, percent):
    source, wanted = Counter(), Counter()
    for _, text in rows:
        source.update(c % buckets for c in runs_of(text)[1])
    for text in targets:
        wanted.update(c % buckets for c in runs_of(text)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        n, crcs = runs_of(text)
        weight = sum(gain[c % buckets] for c in crcs)
        h = int(hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(crcs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    enough = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, row in enumerate(enough[: percent * len(enough) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.fixture(scope="module")
def targets(spark):
    return keep(spark.createDataFrame([("abcdeab aaaaaaa straßen",), (None,), ("",), ("ab ab AB",), ("ü ☃ é w1 w2",)], "text string"))


@pytest.mark.parametrize("percent, least, buckets", [(5, 20, 10_000), (50, 3, 17), (100, 0, 1), (0, 20, 100), (30, 10_000, 10)])
def test_draw_matches_brute_force(docs, targets, percent, least, buckets):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = expected_draw(rows, [r["text"] for r in targets.collect()], buckets, least, percent)
    got = importance.resample(docs, targets, percent=percent, least_words=least, buckets=buckets)
    assert table(got) == want


def test_draw_from_and_towards_nothing(empty, docs, targets):
    assert importance.resample(empty, targets).collect() == []
    assert importance.resample(docs, targets.limit(0)).count() == docs.count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB1 -é☃\n", max_size=30)), max_size=12))
def test_runs_of_a_batch(texts):
    found = importance.Features(pa.array(texts, pa.string()), 97)
    counts = Counter(c % 97 for t in texts for c in runs_of(t)[1])
    assert found.counts(97).tolist() == [counts[b] for b in range(97)]
    gains = np.arange(97) - 40
    number, weight = found.sums(gains)
    assert number.tolist() == [len(runs_of(t)[1]) for t in texts]
    assert weight.tolist() == [sum(int(gains[c % 97]) for c in runs_of(t)[1]) for t in texts]


def test_crc_of_appended_texts():
    parts = [b"", b" a", b" \xc3\xa9", b" " + b"x" * 70_000, b" b"]
    before = np.array([zlib.crc32(b"start"), 0, 0xFFFFFFFF], dtype=np.uint32)
    crc = importance.Crc(parts)
    for i, part in enumerate(parts):
        want = [zlib.crc32(part, int(b)) for b in before]
        assert crc.after(before, np.full(3, i)).tolist() == want


# ---- earlier operators: what this round changed ------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=2, max_size=30))
def test_grid_distance_is_a_lower_bound(prints):
    """The Manhattan distance of segment counts never exceeds the number of differing bits."""
    fp = np.array(prints, np.int64)
    grid = simhash._embedded(fp)
    for i, x in enumerate(prints):
        for j, y in enumerate(prints):
            segments = [abs((x >> s & 3).bit_count() - (y >> s & 3).bit_count()) for s in range(0, 64, 2)]
            assert bool(simhash._near(grid[i:i + 1], grid[j:j + 1], sum(segments))[0])
            assert not sum(segments) or not simhash._near(grid[i:i + 1], grid[j:j + 1], sum(segments) - 1)[0]
            assert sum(segments) <= ((x ^ y) & (2**64 - 1)).bit_count()


def test_risk_with_a_known_prior():
    """Unlabelled text with a third of positives: the corrected risk finds the negatives, the uncorrected one does not."""
    rng = np.random.default_rng(4)

    def drawn(toxic):
        own = rng.integers(0, 40, 6) if toxic else rng.integers(40, 80, 6)
        return np.unique(np.concatenate([own, rng.integers(80, 400, 20)])).astype(np.int32)

    positive = [drawn(True) for _ in range(400)]
    unlabelled = [drawn(i % 3 == 0) for i in range(1500)]

    def scored(weights, bias, rows):
        return np.array([1 / (1 + np.exp(-np.clip(weights[r].sum() + bias, -30, 30))) for r in rows])

    weights, bias = toxicity.train(positive, unlabelled, 1 / 3)
    good, bad = [drawn(False) for _ in range(300)], [drawn(True) for _ in range(300)]
    assert (scored(weights, bias, good) < 0.5).mean() > 0.95 and (scored(weights, bias, bad) > 0.5).mean() > 0.95

    def risk(prior):
        p, u = scored(weights, bias, positive), scored(weights, bias, unlabelled)
        return prior * (1 - p).mean() + max(0.0, u.mean() - prior * p.mean())

    truth = (1 - scored(weights, bias, bad)).mean() / 3 + scored(weights, bias, good).mean() * 2 / 3
    assert risk(1 / 3) == pytest.approx(truth, abs=0.05)


def test_toxicity_sample_holds_labelled_documents_too(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda p, u, prior: seen.update(p=len(p), u=len(u), prior=prior) or (np.zeros(toxicity.FEATURES), 0.0))
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(ids[0], "another")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(n < 20)) for n, i in enumerate(ids[:100])], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    assert seen == {"p": 20, "u": len(ids), "prior": pytest.approx(0.2)}


def test_confidence_grows_until_it_settles(spark):
    """A chain: each identifier becomes sure only through the one before it, further than three rounds reach."""
    edges, totals = [], []
    for link in range(6):
        for n in range(3):
            known = 0 if link == 0 else -1
            edges += [(f"p{link}", f"v{link}{n}", known, 10), (f"p{link}", f"v{link + 1}{n}", -1, 1)]
        totals.append((f"p{link}", 33))
    made = spark.createDataFrame(edges, "pattern string, value string, k int, n long")
    found = {r["value"]: r["confidence"] for r in pii.score_graph(made, spark.createDataFrame(totals, "pattern string, total long")).collect()}
    assert {f"v{link}{n}" for link in range(1, 7) for n in range(3)} <= set(found)
    assert all(found[f"v{link}0"] > 0.8 for link in range(1, 6))
