"""Phrase collocations, source mixing, filter audit: brute force and defined cases."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from odspark.llm import collocations, filter_audit, source_mix
from .conftest import space_words, texts

WIDE = "doc_id long, text string, lang string, source string, key string, rows string, row string, part string, fails string, n string, a string, rank string, copies string"


def _wide(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 9) for r in rows], WIDE).repartition(3)


# ---- collocations ----

def brute_collocations(rows, top):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        c = {g: a for g, a in counts.items() if len(g) > 1 and a >= 30}
        found = []
        for g, a in c.items():
            longer = [b for h, b in c.items() if len(h) > len(g) and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, k = min((2_000_000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (s, a, g, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, g.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def phrase_rows():
    r = random.Random(5)
    vocab = [f"w{k}" for k in range(12)] + ["É", "a-b", "x\x00y", "long" * 30]
    rows = []
    for i in range(160):
        words = [r.choice(vocab[:4 + i % 12]) for _ in range(60)]
        words[10:10] = ["New", "york", "City", "hall"] if i % 2 else ["new\t", " york"]
        words[30:30] = ["of the.", "x;y", "tail\nhead"]
        rows.append((i, "  ".join(words), [None, "und", "en", "de"][i % 4], "s"))
    return rows + [(900, None, "en", "s"), (901, "", None, "s"), (902, " . ", "fr", None), (1, rows[1][1], "und", "s")]


@pytest.mark.parametrize("head", [collocations.HEAD, 5])
def test_collocations_by_brute_force_with_and_without_a_tail(spark, head):
    rows = phrase_rows()
    found = collocations.mine(_wide(spark, rows), top=25, head=head)
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, 25)


def test_collocations_of_nothing(spark):
    assert collocations.mine(_wide(spark, [])).count() == 0
    assert collocations.mine(_wide(spark, [(1, None, None, None), (2, "one two", "en", None)])).count() == 0


def test_cells_of_dense_and_sparse_tiles(monkeypatch):
    monkeypatch.setattr(collocations, "DENSE", 50)
    r = np.random.default_rng(3)
    left = np.concatenate([r.integers(0, 40, 5000), r.integers(0, 1 << 20, 3000), r.integers(1000, 1060, 500)]).astype(np.uint64)
    right = np.concatenate([r.integers(1020, 1050, 5000), r.integers(0, 1 << 20, 3000), r.integers(2000, 2100, 500)]).astype(np.uint64)
    for shift in (0, 1 << 62):
        x = left.copy()
        x[-200:] += np.uint64(shift)
        found = Counter({(int(a), int(b)): int(n) for a, b, n in zip(*collocations.count_cells(x, right))})
        assert found == Counter(zip(x.tolist(), right.tolist()))


# ---- source mix ----

def brute_targets(sizes):
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, total = {}, sum(sizes.values())
    while True:
        rest, w = total - sum(target.values()), sum(v for s, v in weights.items() if s not in target)
        above = [s for s in sizes if s not in target and 3 * sizes[s] * w < weights[s] * rest]
        if not above:
            return {s: target.get(s, weights[s] * rest / w if w else 0) for s in sizes}
        target |= {s: 3 * sizes[s] for s in above}


def mix_rows():
    r = random.Random(2)
    rows = []
    for k in range(900):
        source = "hot" if k % 3 == 0 else ["a", "b", "", None, "z", "é", "tiny"][k % 7]
        n = r.randrange(0, 4) if source == "tiny" else r.choice([0, 5, 40, 900])
        rows.append((k, None if n == 0 and k % 2 else "w " * n, "en", source))
    return rows + [(None, "no id at all", "en", "a"), (None, None, "en", "a"), (5, "same id", "en", "b"), (7, "", "en", "empty source"), rows[3]]


def test_mix_by_brute_force(spark):
    rows = mix_rows()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(space_words(t))
    want = brute_targets(sizes)
    docs = _wide(spark, rows)
    found = source_mix.mix(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in found) == Counter((i, len(space_words(t)), s) for i, t, _, s in rows)
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.02 * t, 900), s
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    # reruns agree, and the mix itself holds as many rows and words
    assert Counter(map(tuple, source_mix.mix(docs.repartition(2)).collect())) == Counter(map(tuple, found))
    out = source_mix.emit(docs)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r["source"]] += len(space_words(r["text"]))
    assert +got == +taken


def test_mix_of_nothing_and_of_many_sources(spark):
    assert source_mix.mix(_wide(spark, [])).count() == 0
    assert source_mix.mix(_wide(spark, [(1, None, "en", None)])).collect()[0]["taken"] == 0
    many = _wide(spark, [(k, "w " * (k % 9), "en", f"s{k % 1500}") for k in range(3000)])   # more sources than can be heavy
    sizes = Counter()
    for k in range(3000):
        sizes[f"s{k % 1500}"] += k % 9
    want = brute_targets(sizes)
    found = source_mix.mix(many).collect()
    assert len(found) == 3000 and all(r["target"] == pytest.approx(want[r["source"]]) for r in found)


def test_mix_is_native(spark):
    plan = source_mix.mix(_wide(spark, mix_rows()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- filter audit ----

def brute_audit(rows, labels):
    first = {}
    for i, t, _, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, _, s in rows:
        t = t or ""
        w = space_words(t)
        bad = {f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search("[#$%&*|]", t),
                                           i is not None and i > first[t])) if x}
        parts[s or ""].append((bad, i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                here = [d for d in docs if f in d[0] and not d[0] & before]
                shapley[f] += len(here)
                out[part, order, step] = [len([d for d in docs if not d[0] & (before | {f})]), len(here), len([d for d in docs if f in d[0] and d[0] & before]),
                                          len([d for d in docs if d[0] == {f}]), sum(d[1] for d in here), sum(d[2] for d in here)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def audit_rows():
    r = random.Random(9)
    pool = texts() + ["Word " * 250, " ".join(f"v{k}" for k in range(260)), " ".join(f"v{k}" for k in range(260)) + " $"]
    rows = [(k, r.choice(pool), "en", ["hot", "hot", None, "", "b"][k % 5]) for k in range(400)]
    return rows + [(None, pool[6], "en", "hot"), (None, pool[6], "en", "hot"), (3, pool[6], "en", "only one"), (0, pool[6], "en", "b"), rows[9]]


def test_audit_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE_BITS", 5)
    rows = audit_rows()
    labels = [(k, k % 2, k % 3 % 2) for k in range(0, 390, 2)] + [(4, 0, None), (4, 1, 1), (None, 1, 1), (8, None, None), (10_000, 1, 1)]
    found = filter_audit.audit(_wide(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = brute_audit(rows, labels)
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in found} == want
    assert len(found) == len(want)


def test_audit_of_nothing_and_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(_wide(spark, []), none).count() == 0
    clean = filter_audit.audit(_wide(spark, [(1, " ".join(f"v{k}" for k in range(260)), "en", None)]), none).collect()
    assert len(clean) == 600 and all(tuple(r)[3:] == (1, 0, 0, 0, 0, 0, 0) for r in clean)


def test_unions_by_galloping():
    r = random.Random(1)
    for _ in range(200):
        lists = [np.array(sorted(r.sample(range(60), r.choice([0, 1, 5, 50]))), np.int64) for _ in range(6)]
        sizes = filter_audit.union_sizes(lists[:5], lists[5:])
        for mask in range(32):
            union = set().union(*[lists[k].tolist() for k in range(5) if mask >> k & 1])
            assert sizes[mask] == (len(union), len(union & set(lists[5].tolist())))
