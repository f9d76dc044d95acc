"""N-gram Jaccard join (op 2): exact set similarity by universe partition, one-deletion neighbourhoods and the pigeonhole principle.

A document is the set of its distinct 3-word shingles (64-bit hashes). Sets of similar size fall into size bands. Two sets A, B with Jaccard
similarity >= t differ in at most H = (1 - t) / (1 + t) * (|A| + |B|) shingles. For each band the universe of shingles is cut into m
segments by hash; a segment with value 1 is indexed by its exact subset, one with value 2 by its exact subset and all its one-deletion
neighbours (it then matches subsets that differ in one shingle). When the values add up to H + 1, two similar sets share an index
entry in some segment, because otherwise they would differ in more than H shingles. A segment without shingles is no entry of a set that has few
of them, because equal segments are then left that hold some; else sets with nothing in common would meet there. The number of segments and of one-deletion segments
is chosen for each band by cost: entries written against false candidates expected from the number of documents in the band.

Copies with equal sets are one class before anything is indexed. Candidates whose sketches (bits that tell whether a part of the universe holds
an odd number of a set's shingles) differ in more places than similar sets can differ in shingles are dropped; the others are verified on the whole sets, which
travel for them alone. Each class is first
compared with the centre of its buckets only; links found merge classes into components. Then every pair of classes that share a bucket and are still in
different components is verified, in small buckets pair by pair, in large ones block by block, so that no link between components is
lost while a large group of copies costs about one comparison per member.

Defined cases: null and empty texts and texts without words have the empty set, which links with nothing; with fewer words than a shingle the whole
sequence is the one shingle; documents without id take part, and a component's id is its smallest id (null if it has none); repeated rows are
members of one class. Extra columns are ignored by `components` and passed through by `keep_one`. Set ids and shingles are 64-bit hashes: for n distinct
sets the chance that any two share an id is about n * n / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.llm.common import Memo, held, small_batches, stored, table

N = 3                 # words of a shingle
THRESHOLD = 90        # similarity in hundredths
BAND_RATIO = 1.3      # largest size of a band over its smallest, about
COMMON_SHARE = 0.1    # cost model: chance that another document of the band shares a given shingle
PAIR_COST = 4.0       # cost model: one candidate against one index entry
SPARE = 2             # segments beyond the pigeonhole's number in bands of SPARE_FROM segments or more: sets with so many empty segments need no entry for them
SPARE_FROM = 8
SMALL_BUCKET = 4096   # open pairs of a bucket that are joined one by one (each pair once for all buckets); more are compared block by block
BLOCK = 512           # sets of a block, about
FILTER_BITS = 26      # log2 of the bits of the membership filter (8 MB), a bound that does not grow with the input
SKETCH_WORDS = 32     # 64-bit words of a set's sketch

MASK = (1 << 64) - 1


def _mix(x):
    """Finalizer of a 64-bit hash on an array of unsigned integers (wraps)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def _words() -> Memo:
    """Word -> 64-bit hash, of this worker."""
    return held("ngram_join", "words", lambda: Memo(_hash))


def shingle_set(text: bytes | None, n: int = N):
    """Sorted distinct shingle hashes (uint64) of a UTF-8 text."""
    import numpy as np

    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, 0x9E3779B97F4A7C15 * size & MASK, np.uint64)
    for k in range(size):
        out = _mix(out * np.uint64(0x2545F4914F6CDD1D) + h[k:k + len(out)])
    return np.unique(out)


def _flat(texts: list[bytes | None], n: int):
    """Concatenated sets of a batch, their sizes and their 64-bit ids."""
    import numpy as np

    sets = [shingle_set(t, n) for t in texts]
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(flat ^ np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64)])
    ids = _mix((total[starts[1:]] - total[starts[:-1]]) ^ _mix(sizes.astype(np.uint64)))
    return flat, sizes, starts, ids


# ---- bands and allocation (driver, a few numbers) ----

def band_starts(largest: int, threshold: int = THRESHOLD) -> list[int]:
    """Smallest sizes of the bands up to `largest`, and the first size beyond. Similar sets lie in one band or in neighbouring ones."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(int(out[-1] * BAND_RATIO), out[-1] * 100 // threshold + 1))
    return out


def allocation(low: int, high: int, documents: int, threshold: int = THRESHOLD) -> tuple[int, int]:
    """(segments, of them with one-deletion neighbours) of a band of sizes low..high; values add up to the largest difference + 1."""
    need = 2 * high * (100 - threshold) // (100 + threshold) + 1
    if need >= SPARE_FROM:
        need += SPARE
    size, best = (low + high) / 2, (float("inf"), need, 0)
    steps = sorted({round(need // 2 * k / 32) for k in range(33)})
    for double in steps:
        m = need - double
        part = size / m
        entries = (m - double) + double * (1 + part)
        # empty segments are not entries (see signatures), so each shared one costs a common shingle at least
        false = documents * ((m - double) * COMMON_SHARE ** part + double * (1 + part) * COMMON_SHARE ** max(part - 1, 0))
        best = min(best, (entries + PAIR_COST * false, m, double))
    return best[1], best[2]


def plan(sizes: dict[int, int], largest: int, threshold: int = THRESHOLD) -> list[tuple[int, int, int]]:
    """(smallest size, segments, one-deletion segments) per band; sizes: band -> documents."""
    starts = band_starts(largest, threshold)
    return [(a, *allocation(a, b - 1, sizes.get(k, 0) + sizes.get(k - 1, 0), threshold)) for k, (a, b) in enumerate(zip(starts, starts[1:]))]


def signatures(flat, sizes, starts, bands: list[tuple[int, int, int]], threshold: int = THRESHOLD):
    """Index entries (uint64) of a batch of sets and the set that each belongs to. A set is indexed for its own band and, where it can be
    the smaller set of a pair, for the next one."""
    import numpy as np

    low = np.array([b[0] for b in bands], np.int64)
    own = np.searchsorted(low, sizes, "right") - 1
    entries, owners = [], []
    for step in (0, 1):
        band = own + step
        use = (sizes > 0) & (band < len(bands))
        band = np.minimum(band, len(bands) - 1)
        if step:
            use &= 100 * sizes >= threshold * low[band]
        doc = np.flatnonzero(use)
        if not len(doc):
            continue
        m = np.array([b[1] for b in bands], np.int64)[band[doc]]
        double = np.array([b[2] for b in bands], np.int64)[band[doc]]
        offset = np.concatenate([[0], np.cumsum(m)])
        # one row per (set, segment): the sum of its shingles' mixes identifies the subset
        n = sizes[doc]
        at = np.repeat(starts[doc] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        u = flat[at]
        segment = (_mix(u) % np.repeat(m, n).astype(np.uint64)).astype(np.int64)
        cell = np.repeat(offset[:-1], n) + segment
        weight = _mix(u + np.uint64(0xA0761D6478BD642F))
        sums = np.zeros(offset[-1], np.uint64)
        np.add.at(sums, cell, weight)
        place = np.arange(offset[-1]) - np.repeat(offset[:-1], m)
        key = _mix((np.repeat(band[doc], m).astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + np.uint64(0x8EBC6AF09C88C6E3))
        # Segments without any shingle. Values of all segments less the differences that a partner can have are left for equal segments: with fewer
        # empty exact segments than that, one of them holds a shingle, and the empty ones need no entry. A pair has such a segment if either side has.
        filled = np.bincount(cell, minlength=offset[-1])
        empty = (filled == 0) & (place >= np.repeat(double, m))
        partner = np.minimum(n * 100 // threshold, np.array([b[0] for b in bands[1:]] + [1 << 62], np.int64)[band[doc]] - 1)
        most = (n + partner) * (100 - threshold) // (100 + threshold)
        bare = np.add.reduceat(empty.astype(np.int64), offset[:-1])
        skip = empty & np.repeat(bare < m + double - most, m)
        entries.append(_mix(sums ^ key)[~skip])
        owners.append(np.repeat(doc, m)[~skip])
        deleted = segment < np.repeat(double, n)
        if deleted.any():
            c = cell[deleted]
            entries.append(_mix((sums[c] - weight[deleted]) ^ key[c]))
            owners.append(np.repeat(doc, n)[deleted])
    return (np.concatenate(entries), np.concatenate(owners)) if entries else (np.empty(0, np.uint64), np.empty(0, np.int64))


# ---- Spark ----

def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles and set_id (equal for equal sets; null for the empty set)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            _, sizes, _, ids = _flat(b.column(2).cast(pa.binary()).to_pylist(), n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes), pa.array(ids.view(np.int64), mask=sizes == 0)], names=["doc_id", "text_hash", "n_shingles", "set_id"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, set_id long")


def entries(docs: DataFrame, bands: list[tuple[int, int, int]], text_col: str = "text", n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """Index entries (entry, set_id); equal sets of one partition are indexed once."""
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        seen: set[int] = set()
        for b in batches:
            flat, sizes, starts, ids = _flat(b.column(0).cast(pa.binary()).to_pylist(), n)
            first = np.zeros(len(ids), bool)
            for i, x in enumerate(ids.tolist()):
                if x not in seen:
                    seen.add(x)
                    first[i] = True
            entry, owner = signatures(flat, np.where(first, sizes, 0), starts, bands, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(entry.view(np.int64)), pa.array(ids[owner].view(np.int64))], names=["entry", "set_id"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "entry long, set_id long")


def bitmap(rows: DataFrame, key: str):
    """A broadcast bitmap of fixed size (2^FILTER_BITS bits) of the values of a long column: what it lacks is not among them. Joins still decide."""
    bit = F.pmod(key, F.lit(1 << FILTER_BITS)) + 1  # bitmap buckets are numbered from 1
    parts = (rows.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("at"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect())
    return rows.sparkSession.sparkContext.broadcast({r["at"]: bytes(r["bits"]) for r in parts})


def bit_test(parts: dict):
    """A function that tells which numbers of an int64 array the bitmap may hold."""
    import numpy as np

    bits = np.zeros((max(parts, default=0) + 1) * 4096, np.uint8)
    for k, v in parts.items():
        bits[(k - 1) * 4096:(k - 1) * 4096 + len(v)] = np.frombuffer(v, np.uint8)

    def test(values):
        place = values % (1 << FILTER_BITS)
        out = place < 8 * len(bits)
        place = place[out]
        out[out] = bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
        return out
    return test


def may_hold(wanted, key: Column) -> Column:
    """Whether the bitmap (the result of `bitmap`) may hold a value of a long column: rows that it lacks need no shuffle to a join with its rows."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        among = bit_test(wanted.value)
        for b in batches:
            yield pd.Series(among(b.to_numpy()))

    # not deterministic for the optimizer: it would test the rows on the other side of an equi-join too, however many they are
    return F.pandas_udf(run, "boolean").asNondeterministic()(key)


def sketches(flat, owner, count: int):
    """Per set SKETCH_WORDS 64-bit words (int64): each bit is the parity of the number of its shingles in one part of the universe. A shingle that one
    of two sets lacks turns one bit, so the sketches of two sets differ in no more bits than the sets in shingles."""
    import numpy as np

    width = 64 * SKETCH_WORDS
    part = (_mix(flat + np.uint64(0xE7037ED1A0B428DB)) % np.uint64(width)).astype(np.int64)
    odd = np.bincount(owner * width + part, minlength=count * width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(count, SKETCH_WORDS)


def sets_of(docs: DataFrame, members: DataFrame, text_col: str = "text", n: int = N) -> DataFrame:
    """(set_id, size, sketch, shingles) of the sets in `members` (column set_id), one row each."""
    # the bitmap keeps most other sets out of the shuffle
    wanted = bitmap(members, "set_id")

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        among = bit_test(wanted.value)
        seen: set[int] = set()
        for b in batches:
            flat, sizes, starts, ids = _flat(b.column(0).cast(pa.binary()).to_pylist(), n)
            take = []
            for i in np.flatnonzero((sizes > 0) & among(ids.view(np.int64))).tolist():
                if (x := int(ids[i])) not in seen:
                    seen.add(x)
                    take.append(i)
            parts = [flat[starts[i]:starts[i + 1]] for i in take]
            sketch = sketches(np.concatenate([np.empty(0, np.uint64), *parts]), np.repeat(np.arange(len(take)), sizes[take]), len(take))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[take].view(np.int64)), pa.array(sizes[take], pa.int32()), pa.array([*sketch], pa.list_(pa.int64())),
                 pa.array([x.view(np.int64) for x in parts], pa.list_(pa.int64()))], names=["set_id", "size", "sketch", "shingles"])

    small_batches(docs.sparkSession)
    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "set_id long, size int, sketch array<long>, shingles array<long>")
    return found.join(members, "set_id", "left_semi").groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("size", "sketch", "shingles")])


def near_pairs(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) that may have the similarity by their sizes and sketches; no pair that has it is left out."""
    side = lambda k: sets.select(F.col("set_id").alias(k), F.col("size").alias(f"{k}_size"), F.col("sketch").alias(f"{k}_sketch"))
    apart = F.expr("aggregate(zip_with(a_sketch, b_sketch, (u, v) -> CAST(bit_count(u ^ v) AS INT)), 0, (s, n) -> s + n)")
    total = F.col("a_size").cast("long") + F.col("b_size")
    # similar sets differ in no more than (1 - t) / (1 + t) of their summed sizes
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("a_size", "b_size") >= threshold * F.greatest("a_size", "b_size"))
            .where((100 + threshold) * apart <= (100 - threshold) * total).select("a", "b"))


def verified(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity, by the whole sets. Only pairs that the sketches leave meet whole sets."""
    pairs = stored(near_pairs(pairs, sets, threshold), "near")
    sets = sets.where(may_hold(bitmap(pairs.select(F.explode(F.array("a", "b")).alias("set_id")), "set_id"), F.col("set_id")))
    a, b = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    close = 100 * F.least(F.size("x"), F.size("y")) >= threshold * F.greatest(F.size("x"), F.size("y"))
    return pairs.join(a, "a").join(b, "b").where(close).where(100 * both >= threshold * (F.size("x") + F.size("y") - both)).select("a", "b")


def connected(links: DataFrame) -> DataFrame:
    """(set_id, label) of every linked set; label: the smallest set id of its component. Rounds of neighbour minima and pointer jumps."""
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("set_id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("set_id").alias("b"), "label"), "b").groupBy(F.col("a").alias("set_id")).agg(F.min("label").alias("near")))
        step = labels.join(near, "set_id").select("set_id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("set_id").alias("low"), F.col("label").alias("far"))
        new = stored(step.join(jump, "low").select("set_id", F.least("low", "far").alias("label"), (F.least("low", "far") < F.col("label")).alias("moved")), "labels")
        labels = new.select("set_id", "label")
        if new.where("moved").isEmpty():
            return labels


def buckets(index: DataFrame) -> DataFrame:
    """(entry, set_id): the distinct members of every entry that two or more sets share."""
    # partial minima and maxima tell which entries are shared; only their rows meet again
    shared = stored(index.groupBy("entry").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high").select("entry"), "shared")
    # the bitmap keeps most entries of one set only out of the second shuffle
    wanted = bitmap(shared, "entry")

    def run(batches) -> Iterator:
        among = bit_test(wanted.value)
        for b in batches:
            yield b.filter(among(b.column(0).to_numpy()))

    return index.mapInArrow(run, index.schema).join(shared, "entry", "left_semi").distinct()


def central_pairs(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: each set with the one member of its buckets that it meets most often as the bucket's centre: the member whose buckets are fullest."""
    degree = rows.join(rows.groupBy("entry").agg(F.count("*").alias("n")), "entry").groupBy("set_id").agg(F.sum("n").alias("degree"))
    centre = (rows.join(degree, "set_id").groupBy("entry").agg(F.max(F.struct("degree", "set_id")).alias("c"))
              .select("entry", F.col("c.set_id").alias("centre")))
    met = rows.join(centre, "entry").where("set_id != centre").groupBy("set_id", "centre").agg(F.count("*").alias("n"))
    best = met.groupBy("set_id").agg(F.max(F.struct("n", "centre")).alias("m"))
    return best.select(F.least("set_id", "m.centre").alias("a"), F.greatest("set_id", "m.centre").alias("b")).distinct()


def block_links(open_rows: DataFrame, large: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between components inside large buckets. The members outside the bucket's largest component are compared with all
    members, block against block; a block holds about BLOCK sets, so that no task sees a whole bucket, and only links leave the tasks.
    large: (entry, label, members, others) with the label of the largest component."""
    held = open_rows.join(large.withColumnRenamed("label", "main"), "entry")
    sets = sets.select("set_id", "shingles").where(may_hold(bitmap(held, "set_id"), F.col("set_id")))
    lefts, rights = F.ceil(F.col("others") / BLOCK).cast("int"), F.ceil(F.col("members") / BLOCK).cast("int")
    at = lambda n: F.pmod(F.xxhash64("set_id"), n).cast("int")
    left = held.where("label != main").select("entry", "set_id", "label", at(lefts).alias("i"), F.explode(F.sequence(F.lit(0), rights - 1)).alias("j"), F.lit(0).alias("side"))
    right = held.select("entry", "set_id", "label", F.explode(F.sequence(F.lit(0), lefts - 1)).alias("i"), at(rights).alias("j"), F.lit(1).alias("side"))
    blocks = left.unionByName(right).join(sets, "set_id")

    def compare(pdf):
        import numpy as np
        import pandas as pd

        x, y = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        parts = [np.asarray(v) for v in [*x["shingles"], *y["shingles"]]]
        sizes = np.array([len(v) for v in parts])
        _, place = np.unique(np.concatenate(parts), return_inverse=True)
        owner = np.repeat(np.arange(len(parts)), sizes)
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        both = np.zeros((len(x), len(y)), np.float32)
        width = 4096                                   # shingles at a time: the matrices stay small
        for start in range(0, int(place[-1]) + 1, width):
            lo, hi = np.searchsorted(place, [start, start + width])
            cells = np.zeros((len(parts), width), np.float32)
            cells[owner[lo:hi], place[lo:hi] - start] = 1
            both += cells[:len(x)] @ cells[len(x):].T
        both = np.rint(both).astype(np.int64)
        total = sizes[:len(x), None] + sizes[None, len(x):] - both
        link = (100 * both >= threshold * total) & (x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None, :])
        u, v = np.nonzero(link)
        out = pd.DataFrame({"a": x["set_id"].to_numpy()[u], "b": y["set_id"].to_numpy()[v], "to": y["label"].to_numpy()[v]})
        return out.drop_duplicates(["a", "to"])[["a", "b"]]   # one link of a set to a component joins them

    return blocks.groupBy("entry", "i", "j").applyInPandas(compare, "a long, b long")


def links(docs: DataFrame, found: DataFrame, threshold: int = THRESHOLD, n: int = N) -> DataFrame | None:
    """(set_id, label): components of linked sets; None if no two sets share an entry. found: the result of `classes`."""
    top = found.agg(F.max("n_shingles")).first()[0] or 0
    starts = band_starts(top, threshold)
    band = F.expr(f"size(filter(array({','.join(f'{s}L' for s in starts)}), s -> s <= n_shingles)) - 1")
    counts = {r["band"]: r["n"] for r in found.where("n_shingles > 0").groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}
    rows = stored(buckets(stored(entries(docs, plan(counts, top, threshold), n=n, threshold=threshold), "entries")), "buckets")
    members = stored(rows.select("set_id").distinct(), "members")
    if members.isEmpty():
        return None
    sets = stored(sets_of(docs, members, n=n), "sets")
    good = stored(verified(central_pairs(rows), sets, threshold), "good")
    labels = connected(good)
    # the buckets that still hold sets of two or more components: every pair of sets of different components is compared
    state = rows.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    mixed = state.groupBy("entry", "label").agg(F.count("*").alias("n")).groupBy("entry").agg(
        F.sum("n").alias("members"), F.max(F.struct("n", "label")).alias("m"), F.count("*").alias("labels")).where("labels > 1")
    mixed = stored(mixed.select("entry", "members", F.col("m.label").alias("label"), (F.col("members") - F.col("m.n")).alias("others")), "mixed")
    open_rows = stored(state.join(mixed.select("entry"), "entry", "left_semi"), "open")
    product = F.col("members") * F.col("others")
    small, large = mixed.where(product <= SMALL_BUCKET), mixed.where(product > SMALL_BUCKET)
    here = open_rows.join(small.select("entry", F.col("label").alias("main")), "entry")
    pairs = (here.where("label != main").join(open_rows.select("entry", F.col("set_id").alias("y"), F.col("label").alias("other")), "entry").where("label != other")
             .select(F.least("set_id", "y").alias("a"), F.greatest("set_id", "y").alias("b")).distinct())
    more = verified(pairs, sets, threshold)
    if not large.isEmpty():
        more = more.union(block_links(open_rows, large, sets, threshold))
    more = stored(more, "more")
    return labels if more.isEmpty() else connected(good.union(more))


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, n: int = N) -> DataFrame:
    """One row per document: the columns of `classes` and label, equal in a component (null for documents without words)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = stored(classes(docs, n=n), "classes")
    labels = links(docs, found, threshold, n)
    if labels is None:
        return found.withColumn("label", F.col("set_id"))
    return found.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, n: int = N) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, set_id, component_id."""
    joined = labelled(docs, id_col, text_col, threshold, n)
    lowest = joined.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("lowest"))
    return joined.join(lowest, "label", "left").select(
        "doc_id", "text_hash", "n_shingles", "set_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, n: int = N) -> DataFrame:
    """One document of each component, with the columns of `docs` (any names): the one with the smallest id (no id comes last), then text hash, then hash
    of the other columns; documents without words all stay."""
    names = docs.columns
    held = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_at, text_at = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}")
    words = labelled(held.select(id_at.alias("doc_id"), text_at.alias("text")), threshold=threshold, n=n).where("label IS NOT NULL")
    keys = words.groupBy("label", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    first = words.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("f"))
    is_first = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_hash") == F.col("f.text_hash"))
    marked = stored(keys.join(first, "label").withColumn("first", is_first).where("NOT first OR copies > 1")
                    .select(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash"), "first"), "marked")
    text_hash = F.xxhash64(text_at.cast("string"))
    key = id_at.eqNullSafe(F.col("key_id")) & (text_hash == F.col("key_hash"))
    # only rows with the text hash of a marked one are shuffled, the others stay where they are
    met = may_hold(bitmap(marked, "key_hash"), text_hash)
    touched = held.where(met)
    kept = held.where(~met).unionByName(touched.join(marked, key, "left_anti"))
    if marked.where("first").isEmpty():
        return kept.toDF(*names)
    # copies of the first row with its id and text: one of them
    row = F.struct(*held.columns)
    again = touched.join(marked.where("first"), key).groupBy("key_id", "key_hash").agg(
        F.min_by(row, F.struct(*[F.xxhash64(F.col(c).cast("string")) for c in held.columns])).alias("r"))
    return kept.unionByName(again.select("r.*")).toDF(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: size of each document's shingle set and its component."""
    return components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies stays."""
    return keep_one(docs)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""
