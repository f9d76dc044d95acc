"""Phrase collocation mining (op 11): direct-address pair tiles, recursively over re-ranked units.

Words are counted per language; those that occur MIN_COUNT times or more get ids by frequency rank (over all languages; a word of each
language has its own id), all others break a phrase, because no phrase is more frequent than its words. A unit of k words is followed by a word:
each such pair (unit id, word id) is one cell. Tasks count the cells of a buffer of pairs: pairs of low ranks fall into square tiles of the
rank x rank plane, and a tile with enough pairs is counted by one dense numpy bincount at direct addresses; the pairs of sparse tiles are sorted
and counted as coordinates. The counted cells are summed by one shuffle. Pairs with MIN_COUNT or more occurrences are re-ranked by frequency and become
the units of the next round, up to MAX_WORDS words; a unit is only extended where the units of its first and of its last words are frequent too.

The HEAD most frequent words and units (bounded, and words by length) are held by every task as a table from key to rank; the rest of the frequent
ones have hashed ids above all ranks and a bitmap of fixed size says which keys can be frequent. A false positive of the bitmap only costs
time: every cell is counted whole and compared with MIN_COUNT. So memory in tasks does not grow with the corpus and nothing is dropped.

Cuts are scored by joins of ids: a phrase has the counts of its beginnings from its first unit and those of its ends from its last one. A phrase
lies in a longer candidate if and only if it lies in one that is a word longer and at least as frequent, so only those are looked at. Products are decimals
of 38 digits.

Hashed keys have 62 bits: for n frequent units beyond HEAD the chance of two alike is about n * n / 2^63.

Defined cases: null and empty texts have no words; the language null counts as `und`, together with a language of that name; repeated rows count each;
words may hold any code point but separators, space and tab; a table without candidates gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odspark.llm.common import LOWER, UPPER, small_batches, stored, table

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SCALE = 2_000_000
INSIDE = 80             # a phrase goes when a longer one has this many hundredths of its count
HEAD = 1 << 18          # words, and units of each length, that tasks hold with their ranks
HEAD_BYTES = 64         # longer words are not held
BUFFER = 1 << 22        # pairs counted at a time
WORD_BUFFER = 400_000   # distinct words that a task holds before it writes their counts
TILE_BITS, TILES = 10, 64   # tiles of 1024 x 1024 cells, in a square of 64 x 64 tiles
DENSE = 1 << (2 * TILE_BITS - 4)   # pairs of a buffer that make a tile dense: a sixteenth of its cells
FILTER_BITS = 26        # log2 of the bits of the bitmap (8 MB)

TAIL = 1 << 62          # ids from here on are hashed keys, ids below HEAD are ranks
NONE = (1 << 64) - 1    # no unit
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(UPPER.encode() + SEPARATORS + b"\t", LOWER.encode() + b"." * len(SEPARATORS) + b" ")


def words_of(texts: list[bytes]) -> list[bytes]:
    """Lower-cased words of the texts; `.` stands for the end of a piece."""
    return b".".join(texts).translate(_TABLE).replace(b".", b" . ").split(b" ")


def _key(left, right):
    """62-bit keys of pairs of ids (uint64 arrays)."""
    import numpy as np

    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & np.uint64(TAIL - 1)


def _word_key(lang: bytes, word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang + b"\0" + word) & (TAIL - 1)


class Bits:
    """Bitmap of 2^FILTER_BITS bits over keys."""

    def __init__(self, parts: dict[int, bytes]):
        import numpy as np

        self.bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for k, v in parts.items():
            self.bits[(k - 1) * 4096:(k - 1) * 4096 + len(v)] = np.frombuffer(v, np.uint8)

    def may_have(self, keys):
        import numpy as np

        at = keys & np.uint64((1 << FILTER_BITS) - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Words:
    """Ids of frequent words. head: language -> {word: rank}; bits: the bitmap of all other frequent words, None if there are none."""

    def __init__(self, head: dict[bytes, dict[bytes, int]], parts: dict[int, bytes] | None):
        self.head, self.bits = head, Bits(parts) if parts else None

    def ids(self, lang: bytes, words: list[bytes]):
        import itertools

        import numpy as np

        get = self.head.get(lang, {}).get
        out = np.fromiter(map(get, words, itertools.repeat(NONE)), np.uint64, len(words))
        if self.bits is not None:
            at = [i for i in np.flatnonzero(out == NONE).tolist() if words[i] and words[i] != b"."]
            keys = np.array([_word_key(lang, words[i]) for i in at], np.uint64)
            out[at] = np.where(self.bits.may_have(keys), keys | np.uint64(TAIL), np.uint64(NONE))
        return out

    def id_of(self, lang: bytes, word: bytes) -> int:
        rank = self.head.get(lang, {}).get(word)
        return _word_key(lang, word) | TAIL if rank is None else rank


class Units:
    """Ids of frequent units of one length. keys: keys of the head in ascending order; ranks: theirs; parts: the bitmap of the others, None if there are none."""

    def __init__(self, keys, ranks, parts: dict[int, bytes] | None):
        self.keys, self.ranks, self.bits = keys, ranks, Bits(parts) if parts else None
        import numpy as np

        self.near = np.zeros(1 << 24, bool)      # most keys of no unit are seen here at once
        self.near[(keys & np.uint64((1 << 24) - 1)).astype(np.int64)] = True

    def ids(self, left, right, exact: bool = False):
        """exact: the pairs are known to be frequent."""
        import numpy as np

        keys = _key(left, right)
        out = np.full(len(keys), NONE, np.uint64)
        at = np.flatnonzero(self.near[(keys & np.uint64((1 << 24) - 1)).astype(np.int64)])
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            found = self.keys[place] == keys[at]
            out[at[found]] = self.ranks[place[found]]
        if self.bits is not None:
            rest = np.flatnonzero(out == NONE)
            known = rest if exact else rest[self.bits.may_have(keys[rest])]
            out[known] = keys[known] | np.uint64(TAIL)
        return out


def count_cells(left, right):
    """(left, right, count) of the distinct pairs: dense tiles by bincount, the others by sorting."""
    import numpy as np

    out = []
    ranks = 1 << TILE_BITS
    rest = np.ones(len(left), bool)
    square = np.flatnonzero((left < ranks * TILES) & (right < ranks * TILES))
    if len(square) >= DENSE:
        x, y = left[square].astype(np.int64), right[square].astype(np.int64)
        tile = (x >> TILE_BITS) * TILES + (y >> TILE_BITS)
        for t in np.flatnonzero(np.bincount(tile, minlength=TILES * TILES) >= DENSE).tolist():
            here = tile == t
            cell = ((x[here] & ranks - 1) << TILE_BITS) | (y[here] & ranks - 1)
            n = np.bincount(cell, minlength=ranks * ranks)
            full = np.flatnonzero(n)
            out.append((((full >> TILE_BITS) + (t // TILES << TILE_BITS)).astype(np.uint64), ((full & ranks - 1) + (t % TILES << TILE_BITS)).astype(np.uint64), n[full]))
            rest[square[here]] = False
    left, right = left[rest], right[rest]
    if len(left):
        if max(left.max(), right.max()) < 1 << 32:
            packed, n = np.unique(left << np.uint64(32) | right, return_counts=True)
            out.append((packed >> np.uint64(32), packed & np.uint64((1 << 32) - 1), n))
        else:
            order = np.lexsort((right, left))
            left, right = left[order], right[order]
            first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
            out.append((left[first], right[first], np.diff(np.concatenate([first, [len(left)]]))))
    return [np.concatenate(c) if out else np.empty(0, np.uint64) for c in (zip(*out) if out else ((), (), ()))]


# ---- Spark ----

def by_lang(batch):
    """(language, texts) of a batch with the columns lang and text."""
    import pyarrow as pa

    held: dict[bytes, list[bytes]] = {}
    for lang, text in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        if text:
            held.setdefault(lang, []).append(text)
    return held.items()


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of all words, and for each language a row with the word null and the number of all its words. texts: lang, text."""
    def run(batches) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        held: dict[bytes, Counter] = {}

        def flush():
            for lang, counts in held.items():
                for nothing in (b"", b"."):
                    counts.pop(nothing, None)
                words, n = list(counts), list(counts.values())
                for i in range(0, len(words), 50_000):
                    part = words[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.binary()).cast(pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                                                      pa.array(n[i:i + 50_000], pa.int64())], names=["lang", "word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.binary()).cast(pa.string()), pa.array([None], pa.string()), pa.array([sum(n)], pa.int64())],
                                                 names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, found in by_lang(batch):
                held.setdefault(lang, Counter()).update(words_of(found))
            if sum(map(len, held.values())) > WORD_BUFFER:
                yield from flush()
        yield from flush()

    counted = texts.mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_units(texts: DataFrame, words, units: list) -> DataFrame:
    """(l, r, a): how often the word r follows the unit l, for units of len(units) + 1 words, where that is MIN_COUNT times or more. words, units: broadcasts."""
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        lefts, rights, held = [], [], 0

        def flush():
            if held:
                left, right, n = count_cells(np.concatenate(lefts), np.concatenate(rights))
                for i in range(0, len(n), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 100_000].astype(np.int64)) for c in (left, right, n)], names=["l", "r", "n"])

        for batch in batches:
            for lang, found in by_lang(batch):
                tokens = words_of(found)
                ids = words.value.ids(lang, tokens)
                ids = ids[np.fromiter(map(len, tokens), np.int64, len(tokens)) > 0]      # several spaces in a row are one
                unit = ids
                for k in range(len(units) + 1):
                    left, right = unit[:-1], ids[k + 1:]
                    both = np.flatnonzero((left != NONE) & (unit[1:] != NONE) & (right != NONE))
                    left, right = left[both], right[both]
                    if k < len(units):
                        unit = np.full(max(len(unit) - 1, 0), NONE, np.uint64)
                        unit[both] = units[k].value.ids(left, right)
                if len(left):
                    lefts.append(left)
                    rights.append(right)
                    held += len(left)
            if held >= BUFFER:
                yield from flush()
                lefts, rights, held = [], [], 0
        yield from flush()

    counted = texts.mapInArrow(run, "l long, r long, n long")
    return counted.groupBy("l", "r").agg(F.sum("n").alias("a")).where(F.col("a") >= MIN_COUNT)


def _bitmap(keys: DataFrame) -> dict[int, bytes]:
    """Bitmap of the column key (2^FILTER_BITS bits at most, whatever the number of rows)."""
    bit = F.col("key").bitwiseAND((1 << FILTER_BITS) - 1) + 1
    rows = (keys.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("at"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect())
    return {r["at"]: bytes(r["bits"]) for r in rows}


def rank_words(frequent: DataFrame, head: int):
    """Broadcast Words of a stored table (lang, word, n), and the table with ids."""
    spark = frequent.sparkSession
    short = frequent.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "lang", "word").limit(head)
    held: dict[bytes, dict[bytes, int]] = {}
    for rank, row in enumerate(short.select("lang", "word").toPandas().itertuples(index=False)):
        held.setdefault(row.lang.encode(), {})[row.word.encode()] = rank
    ranked = spark.sparkContext.broadcast(Words(held, None))
    schema = "lang string, word string, n long, id long"

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            pairs = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([ranked.value.id_of(x.encode(), y.encode()) for x, y in pairs], pa.int64())], names=["lang", "word", "n", "id"])

    numbered = stored(frequent.select("lang", "word", "n").mapInArrow(run, schema), "words")
    tail = numbered.where(F.col("id") >= TAIL)
    parts = _bitmap(tail.select(F.col("id").bitwiseAND(TAIL - 1).alias("key")))
    return (spark.sparkContext.broadcast(Words(held, parts)) if parts else ranked), numbered


def rank_units(counted: DataFrame, head: int):
    """Broadcast Units of a stored table (l, r, a), and the table with ids."""
    import numpy as np

    spark = counted.sparkSession
    top = counted.orderBy(F.desc("a"), "l", "r").limit(head).select("l", "r").toPandas()
    keys = _key(top["l"].to_numpy(np.int64).view(np.uint64), top["r"].to_numpy(np.int64).view(np.uint64))
    order = np.argsort(keys)
    keys, ranks = keys[order], order.astype(np.uint64)
    # the bitmap given here only says that there are others: known pairs need no filter
    ranked = spark.sparkContext.broadcast(Units(keys, ranks, {1: b""}))

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            l, r = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ranked.value.ids(l, r, exact=True).view(np.int64))], names=["l", "r", "a", "id"])

    numbered = stored(counted.select("l", "r", "a").mapInArrow(run, "l long, r long, a long, id long"), "units")
    parts = _bitmap(numbered.where(F.col("id") >= TAIL).select(F.col("id").bitwiseAND(TAIL - 1).alias("key")))
    return spark.sparkContext.broadcast(Units(keys, ranks, parts or None)), numbered


def by_word(rows: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """`rows` joined with the words of ids `key`. The ranked words (HEAD rows of HEAD_BYTES at most) are broadcast: frequent words make heavy keys."""
    ranked, tail = F.broadcast(words.where(F.col(key) < TAIL)), words.where(F.col(key) >= TAIL)
    out = rows.where(F.col(key) < TAIL).join(ranked, key)
    return out if tail.isEmpty() else out.unionByName(rows.where(F.col(key) >= TAIL).join(tail, key))


def phrases(units: DataFrame, shorter: DataFrame, words: DataFrame | None) -> DataFrame:
    """The units (l, r, a, id) as phrases: id, first, last, lang, phrase, a, pre, suf.

    first and last: ids of the phrases without their last and without their first word; pre[j], suf[j]: counts of the first and of the last j + 1 words.
    shorter: phrases that are a word shorter; words: their table where these are single words (None otherwise)."""
    if words is not None:
        left = words.select(F.col("id").alias("l"), "lang", F.col("word").alias("head"), F.array("n").alias("pre"))
        right = words.select(F.col("id").alias("r"), F.col("word").alias("end"), F.array("n").alias("suf"))
        met = by_word(by_word(units, left, "l"), right, "r").withColumn("last", F.col("r"))
    else:
        left = shorter.select(F.col("id").alias("l"), "lang", F.substring_index("phrase", " ", 1).alias("head"), "pre", F.col("last").alias("l2"))
        right = shorter.select(F.col("l").alias("l2"), "r", F.col("id").alias("last"), F.col("phrase").alias("end"), "suf")
        met = units.join(left, "l").join(right, ["l2", "r"])
    return met.select("id", "l", "r", F.col("l").alias("first"), "last", "lang", F.concat_ws(" ", "head", "end").alias("phrase"), "a",
                      F.concat("pre", F.array("a")).alias("pre"), F.concat("suf", F.array("a")).alias("suf"))


def _wide(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def scored(found: DataFrame, longer: DataFrame | None, size: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of `size` words that stay, by their lowest cut."""
    if longer is not None:
        around = longer.select(F.col("first").alias("id"), "a").union(longer.select("last", "a")).groupBy("id").agg(F.max("a").alias("around"))
        found = found.join(around, "id", "left").where(F.col("around").isNull() | (_wide(F.col("around")) * 100 < _wide(F.col("a")) * INSIDE))
    cuts = []
    for k in range(1, size):
        l, r = F.col("pre")[k - 1], F.col("suf")[size - k - 1]
        score = F.expr(f"(CAST(a AS DECIMAL(38,0)) * {SCALE}) div (CAST(pre[{k - 1}] AS DECIMAL(38,0)) + suf[{size - k - 1}])")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    lowest = F.array_min(F.array(*cuts))
    return found.withColumn("cut", lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, head: int = HEAD) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = stored(count_words(texts).where(f"word IS NULL OR n >= {MIN_COUNT}"), "word_counts")
    sizes = counted.where("word IS NULL").select("lang", F.col("n").alias("all_words"))
    words, table_of_words = rank_words(counted.where("word IS NOT NULL"), head)
    units, levels = [], []
    for size in range(2, MAX_WORDS + 1):
        cells = stored(count_units(texts, words, units), "cells")
        held, numbered = rank_units(cells, head)
        levels.append(stored(phrases(numbered, levels[-1] if levels else numbered, None if levels else table_of_words), "phrases"))
        units.append(held)
    kept = None
    for size, found in enumerate(levels, 2):
        part = scored(found, levels[size - 1] if size <= len(levels) else None, size)
        kept = part if kept is None else kept.unionByName(part)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the phrases of each language that its documents hold together most strongly."""
    return mine(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w[i:i + k - 1] AS g, k FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w) x, range(1, 5) r(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, g, k, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
cut AS (SELECT c.lang, c.g, c.k, c.a, j, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, j) JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, j + 1, c.k)),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
sub AS (SELECT lang, g[i:i + m - 1] AS g, max(a) AS around FROM (SELECT lang, g, k, a, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 4) r(m) WHERE m < k) x GROUP BY 1, 2),
kept AS (SELECT low.*, array_to_string(low.g, ' ') AS phrase FROM low LEFT JOIN sub ON sub.lang = low.lang AND sub.g = low.g WHERE sub.around IS NULL OR 100 * sub.around < 80 * low.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""
