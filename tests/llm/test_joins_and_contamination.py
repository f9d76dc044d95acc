"""Benchmark decontamination and the n-gram Jaccard join against brute force."""

import random
from collections import Counter

import pytest

from odspark.llm import decontamination, ngram_join

from .conftest import brute_words


def brute_hits(items, words, window):
    hit, found = set(), set()
    for i, t in items:
        w = [x.encode() for x in brute_words(t)]
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if w else 0):
            for p in range(len(words) - n + 1):
                if words[p:p + n] == w[a:a + n]:
                    hit.update(range(p, p + n))
                    found.add(i)
    return hit, found


def test_automaton_by_brute_force():
    r = random.Random(3)
    for _ in range(600):
        window, letters = r.choice([2, 3, 4, 5]), r.choice(["ab", "abc", "abcd"])
        items = [(str(k), " ".join(r.choice(letters) for _ in range(r.randint(0, 9)))) for k in range(r.randint(0, 6))]
        words = [r.choice(letters + "z").encode() for _ in range(r.randint(0, 30))]
        longest, runs, found = decontamination.Automaton([(i, t.encode()) for i, t in items], window).scan(words)
        assert ({p for s, e in runs for p in range(s, e)}, found) == brute_hits(items, words, window)
        grams = [[x.encode() for x in t.split()] for _, t in items]
        assert longest == max((n for g in grams for a in range(len(g)) for n in range(1, len(g) - a + 1) for p in range(len(words) - n + 1) if words[p:p + n] == g[a:a + n]), default=0)


@pytest.fixture(scope="module")
def items(spark, docs):
    long = next(r["text"] for r in docs.collect() if r["doc_id"] == 10)
    words = long.split()
    rows = [(1, " ".join(words[100:130])), (2, "the end of it"), (2, "two words"), (None, " ".join(words[300:320])), (4, None), (5, "..."), (6, " ".join(words[5000:5100]))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize(("shard_bytes", "chunk_bytes"), [(1 << 20, 1 << 24), (64, 1 << 24), (64, 1), (1, 1000)])
def test_scan_by_brute_force(docs, items, shard_bytes, chunk_bytes):
    pairs = [(None if r["item_id"] is None else str(r["item_id"]), r["text"]) for r in items.collect()]
    rows = decontamination.scan(docs, items, shard_bytes=shard_bytes, chunk_bytes=chunk_bytes).collect()
    assert len(rows) == docs.count()
    for r in rows:
        words = [w.encode() for w in brute_words(r["text"])]
        if len(words) > 1000:
            continue
        hit, found = brute_hits(pairs, words, decontamination.WINDOW)
        assert {p for s, e in zip(r["hit_starts"], r["hit_ends"]) for p in range(s, e)} == hit
        assert r["hit_items"] == sorted(x for x in found if x is not None) and r["n_words"] == len(words)
    by = {r["doc_id"]: r for r in rows}
    assert by[10]["hit_items"] == ["1", "6"] and by[10]["max_match"] >= 100
    assert sum(e - s for s, e in zip(by[10]["hit_starts"], by[10]["hit_ends"])) >= 150   # the item without id hits too


def test_shards_hold_one_automaton_at_a_time(spark, docs, items, monkeypatch):
    """More shards than one: a worker sees them as an iterator, and nothing of the benchmark is broadcast."""
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *a: pytest.fail("broadcast of a benchmark of several shards"))
    shards, automata = decontamination._automata(items, "item_id", "text", 64, decontamination.WINDOW)
    assert shards > 1
    each = automata()
    assert iter(each) is each and 1 < sum(isinstance(a, decontamination.Automaton) for a in each) <= shards


def test_clean_drops_contaminated_and_cuts_long_runs(spark, docs, no_docs, items):
    out = decontamination.clean(docs, items)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    got = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert 4 not in got and 17 not in got and 10 in got and 6 in got
    before = next(r for r in docs.collect() if r["doc_id"] == 10)
    assert len(got[10]["text"]) < len(before["text"]) and got[10]["n_chars"] == len(got[10]["text"])
    words, left = brute_words(before["text"]), brute_words(got[10]["text"])
    item = brute_words(next(r["text"] for r in items.collect() if r["item_id"] == 6))
    at = next(p for p in range(len(words)) if words[p:p + len(item)] == item)
    assert left == words[:at] + words[at + len(item):] and got[12]["text"] == next(r["text"] for r in docs.collect() if r["doc_id"] == 12)
    assert decontamination.clean(no_docs, items).count() == 0
    assert decontamination.clean(docs, items.limit(0)).count() == docs.count()


# ---- n-gram Jaccard join ----

def brute_set(text, n=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(rows, threshold=90):
    sets = [brute_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                group[top(a)] = top(b)
    out = Counter()
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if top(b) == top(a) and rows[b][0] is not None]
        out[(i, len(sets[a]), i if not sets[a] else min(ids, default=None))] += 1
    return out


def near_copies(seed, groups=6, copies=9):
    """Groups of texts with a few changed words: similarities on both sides of the threshold, chains included."""
    r, rows = random.Random(seed), []
    for g in range(groups):
        words = [f"g{g}w{r.randint(0, 10 ** 6)}" for _ in range(r.choice([8, 15, 30, 60, 200]))]
        for c in range(copies):
            if c % 3 == 2:
                words = list(words)          # a chain: the next copies start from this one
                words[r.randrange(len(words))] = f"x{c}"
            new = list(words)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                new[r.randrange(len(new))] = f"y{r.randint(0, 10 ** 6)}"
            rows.append((len(rows), " ".join(new)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, small, block", [(1, 4096, 512), (2, 1, 4), (3, 30, 2)])
def test_components_by_brute_force(spark, monkeypatch, seed, small, block):
    """Small and large buckets: pair by pair and block by block."""
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", small)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(seed, copies=14)
    got = ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_components(rows)


def test_components_of_odd_rows_and_keep_one(spark, docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = ngram_join.components(docs)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_components(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[5] == 1 and 6 not in {r["doc_id"] for r in kept.collect() if r["text"] != "another text under a known id"} and ids[6] == 1
    assert ids[0] == ids[1] == ids[2] == 1 and ids[None] == 1
    assert ngram_join.keep_one(no_docs).count() == 0


def test_keep_one_leaves_one_row_of_each_group(spark):
    """Repeated rows, near copies under one id, copies without id; documents without words all stay."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, "a"), (1, long, "b"), (1, long, "a"), (1, long + " more", "c"), (2, long, "a"), (None, long, "a"),
            (None, "no id here at all", "x"), (None, "no id here at all", "x"), (None, "No id here at all", "y"),
            (7, "one of its own", "z"), (8, "", "e"), (8, "", "e"), (None, None, "e")]
    for parts in (1, 5):
        kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts))
        got = [tuple(r) for r in kept.collect()]
        assert kept.columns == ["doc_id", "text", "lang"] and not Counter(got) - Counter(rows)
        assert Counter(r[0] for r in got) == Counter({1: 1, 7: 1, 8: 2, None: 2})
        assert [r for r in got if r[0] is None and r[1]] and (None, None, "e") in got
        best = {tuple(r) for r in got} if parts == 1 else best
        assert best == set(got)


def test_signatures_meet_for_every_similar_pair():
    """Pigeonhole: sets at or above the threshold share an index entry, in every band, also with one-deletion segments only."""
    import numpy as np

    r = random.Random(5)
    for _ in range(150):
        size = r.choice([1, 3, 9, 10, 12, 19, 40, 150, 700])
        a = {r.getrandbits(64) for _ in range(size)}
        b = set(a)
        while True:                                   # change b as far as the threshold allows
            c = set(b)
            if r.random() < 0.5 and c:
                c.remove(r.choice(sorted(c)))
            else:
                c.add(r.getrandbits(64))
            if 100 * len(a & c) < 90 * len(a | c):
                break
            b = c
        starts = ngram_join.band_starts(1000)
        for mode in ("cost", "exact", "deletions"):
            bands = []
            for lo, hi in zip(starts, starts[1:]):
                need = 2 * (hi - 1) * 10 // 190 + 1
                bands.append((lo, *(ngram_join.allocation(lo, hi - 1, 10 ** 9) if mode == "cost" else (need, 0) if mode == "exact" else (need - need // 2, need // 2))))
            flat = np.concatenate([np.array(sorted(x), np.uint64) for x in (a, b)])
            entry, owner = ngram_join.signatures(flat, np.array([len(a), len(b)]), np.array([0, len(a), len(a) + len(b)]), bands)
            assert set(entry[owner == 0].tolist()) & set(entry[owner == 1].tolist()), (mode, len(a), len(b))


def test_allocation_values_cover_the_largest_difference():
    for lo in (1, 5, 10, 17, 60, 400, 5000):
        for docs in (0, 10, 10 ** 6, 10 ** 10):
            hi = int(lo * 1.3) + 1
            m, double = ngram_join.allocation(lo, hi, docs)
            assert m >= 1 and 0 <= double <= m and 0 <= m + double - (2 * hi * 10 // 190 + 1) <= ngram_join.SPARE


def test_empty_segments_lose_no_link(spark):
    """Sets that differ in as many shingles as similar ones can, of every size: each pair shares an index entry."""
    import numpy as np
    r = np.random.default_rng(8)
    bands = ngram_join.plan({}, 4000)
    for size in [*range(1, 60), 100, 333, 1000, 3000]:
        for _ in range(20):
            a = np.unique(r.integers(0, 1 << 63, size).astype(np.uint64))
            most = next(k for k in range(size, -1, -1) if 100 * (len(a) - k // 2) >= 90 * (len(a) + (k + 1) // 2))
            b = np.unique(np.concatenate([a[most // 2:], r.integers(0, 1 << 63, (most + 1) // 2).astype(np.uint64)]))
            flat, sizes = np.concatenate([a, b]), np.array([len(a), len(b)])
            entry, owner = ngram_join.signatures(flat, sizes, np.array([0, len(a), len(a) + len(b)]), bands)
            assert set(entry[owner == 0].tolist()) & set(entry[owner == 1].tolist()), (size, most)


def test_sets_with_nothing_in_common_do_not_meet(spark):
    import numpy as np
    r = np.random.default_rng(9)
    n, size = 1500, 1000
    flat = r.integers(0, 1 << 63, n * size).astype(np.uint64)
    entry, owner = ngram_join.signatures(flat, np.full(n, size), np.arange(n + 1) * size, ngram_join.plan({}, 1000))
    first = {}
    assert not [1 for e, o in zip(entry.tolist(), owner.tolist()) if first.setdefault(e, o) != o]


def test_sketches_differ_in_no_more_places_than_the_sets():
    """The sketch test drops pairs that are far apart and never one that is similar."""
    import numpy as np

    r, dropped = np.random.default_rng(5), 0
    for _ in range(200):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) > r.choice([0.0, 0.03, 0.3])], r.integers(0, 1 << 62, int(r.integers(0, 30))).astype(np.uint64)]))
        if not len(b):
            continue
        x, y = ngram_join.sketches(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2).view(np.uint64)
        apart = sum(int(v).bit_count() for v in x ^ y)
        assert apart <= len(np.setxor1d(a, b))
        both = len(np.intersect1d(a, b))
        kept = 190 * apart <= 10 * (len(a) + len(b))
        assert kept or 100 * both < 90 * (len(a) + len(b) - both)
        dropped += not kept
    assert dropped > 50


def test_near_pairs_drop_far_pairs_before_whole_sets_travel(spark):
    docs = spark.createDataFrame([(k, " ".join(f"{'w' if k < 2 or i % 3 else 'v'}{i}" for i in range(300 + k))) for k in range(3)], "doc_id long, text string")
    found = {r["doc_id"]: r["set_id"] for r in ngram_join.classes(docs).collect()}
    sets = ngram_join.sets_of(docs, spark.createDataFrame([(v,) for v in found.values()], "set_id long"))
    pairs = spark.createDataFrame([(found[0], found[1]), (found[0], found[2]), (found[1], found[2])], "a long, b long")
    assert [tuple(r) for r in ngram_join.near_pairs(pairs, sets).collect()] == [(found[0], found[1])]
    assert [tuple(r) for r in ngram_join.verified(pairs, sets).collect()] == [(found[0], found[1])]


def test_keep_one_shuffles_only_texts_of_marked_rows(spark):
    """Rows whose text no marked row has come straight from the scan, not through an exchange."""
    docs = spark.createDataFrame([(k, f"text {k} of its own words {k % 5}") for k in range(40)] + [(k, "one text that comes many times over") for k in range(40, 50)], "doc_id long, text string")
    out = ngram_join.keep_one(docs)
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(41))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    first = plan[plan.index("Union"):].split("Join")[0]
    assert "ArrowEvalPython" in first or "run(" in first
