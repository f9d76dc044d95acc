"""Benchmark decontamination (op 1): a generalised suffix automaton of the test items, streamed over the documents' words.

A document's words run through the automaton and the length of the longest match that ends at each word is tracked; the documents are not shuffled
and read once. Items of at most `SHARD_BYTES` of text are broadcast and each Python worker builds their automaton once. More items are dealt to
shards of about that size, written as a table into the shared folder by Spark; a task takes its documents in chunks of about `CHUNK_BYTES`, and for each chunk
reads the shards one after the other and holds one automaton at a time, so memory is bounded whatever the size of the benchmark, of which nothing
passes through the driver then. A single item is never split: one of more than `SHARD_BYTES` makes an automaton of its own size.

A window is `window` consecutive words of an item; an item of fewer, but not none, is one window. Words inside any occurrence of a window are hit.

Defined cases: a null or empty text has no words, no hits and is not contaminated; an item without words has no window; an
item with a null id still hits words but is not listed; equal ids are listed once; without items nothing is hit. Documents
with null or equal ids are judged row by row. Extra columns pass through `scan` and `clean`; the columns that they add replace columns of the same names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.llm.common import add_columns, held, shared_folder, table
from odspark.llm.token_files import file_system

WINDOW = 13           # words of a window
MAX_SHARE = 20        # contaminated: 1 / MAX_SHARE of the words or more are hit
MAX_SPAN = 50         # `clean` cuts runs of hit words longer than this out of documents that stay
SHARD_BYTES = 1 << 20  # text of the items in one automaton, about
CHUNK_BYTES = 16 << 20  # text of the documents that one automaton sees before the next, with more than one shard

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FIELDS = "n_words long, max_match long, hit_starts array<long>, hit_ends array<long>, hit_items array<string>, cut_text string"


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, of UTF-8."""
    return WORD.findall(text.lower()) if text else []


class Automaton:
    """Suffix automaton of several word sequences, with the windows that each state's match ends with."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if w]
        for _, w in sequences:
            last = 0
            for x in w:
                last = self._extend(last, x)
        # top[v]: the state on v's suffix path that holds the match of `window` words, if v's longest match has as many
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.top = [0] * len(self.next)
        for v in order:
            if self.length[v] >= window:
                p = self.link[v]
                self.top[v] = v if self.length[p] < window else self.top[p]
        self.items: dict[int, set] = {}
        marks: dict[int, tuple[int, set]] = {}
        for i, w in sequences:
            v = length = 0
            for x in w:
                v, length = self.next[v][x], length + 1
                if length >= window:
                    self.items.setdefault(self.top[v], set()).add(i)
            if len(w) < window:
                # an item shorter than a window ends in the state of its whole sequence
                marks.setdefault(v, (len(w), set()))[1].add(i)
        # short[v]: (words, item ids) of the short items that can end where v ends, shortest first
        self.short: list[list | None] = [None] * len(self.next)
        for v in order:
            own, above = marks.get(v), self.short[self.link[v]]
            self.short[v] = [*(above or []), own] if own else above

    def _extend(self, last: int, x: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if x in nxt[last]:
            q = nxt[last][x]
            return q if length[q] == length[last] + 1 else self._split(last, x, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and x not in nxt[p]:
            nxt[p][x] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][x]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, x, q)
        return cur

    def _split(self, p: int, x: bytes, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(x) == q:
            nxt[p][x] = clone
            p = link[p]
        return clone

    def scan(self, words: list[bytes]) -> tuple[int, list[list[int]], set]:
        """Longest match, runs of hit words as [start, end) and the items hit."""
        nxt, link, lengths, short, window = self.next, self.link, self.length, self.short, self.window
        v = length = longest = 0
        runs: list[list[int]] = []
        found: set = set()
        for i, x in enumerate(words):
            to = nxt[v].get(x)
            if to is None:
                while v:
                    v = link[v]
                    to = nxt[v].get(x)
                    if to is not None:
                        break
                else:
                    length = 0
                    continue
                length = lengths[v]
            v = to
            length += 1
            if length > longest:
                longest = length
            n = 0
            if short[v] is not None:
                for size, ids in short[v]:
                    if size <= length:
                        n = size
                        found |= ids
            if length >= window:
                n = window
                found |= self.items[self.top[v] if lengths[link[v]] < window else self.top[link[v]]]
            if n:
                start = i + 1 - n
                while runs and runs[-1][1] >= start:
                    start = min(start, runs.pop()[0])
                runs.append([start, i + 1])
        return longest, runs, found


def _automata(items: DataFrame, id_col: str, text_col: str, shard_bytes: int, window: int):
    """The number of shards, and a function for workers that gives their automata one after the other."""
    spark, run = items.sparkSession, uuid.uuid4().hex
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    k = max(1, -(-total // shard_bytes))
    if k == 1:
        shard = spark.sparkContext.broadcast([(r.id, r.text.encode()) for r in rows.collect()])   # shard_bytes of text at most

        def single() -> Iterator[Automaton]:
            yield held("decontamination", run, lambda: Automaton(shard.value, window))
        return 1, single

    folder = shared_folder(spark, "benchmark-shards")
    # the id takes part, so that equal texts under many ids spread over the shards
    rows.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(k))).repartition(F.col("shard")).write.partitionBy("shard").parquet(folder)

    def each() -> Iterator[Automaton]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        files, path = file_system(folder)
        for shard in range(k):
            there = files.get_file_info(fs.FileSelector(f"{path}/shard={shard}", allow_not_found=True))
            part = [r for f in there if f.base_name.endswith(".parquet") for r in pq.ParquetFile(files.open_input_file(f.path)).read().to_pylist()]
            if part:
                yield Automaton([(r["id"], r["text"].encode()) for r in part], window)
    return k, each


def _merged(runs: list[list[int]]) -> list[list[int]]:
    """Runs [start, end) of several automata as runs that neither overlap nor touch."""
    out: list[list[int]] = []
    for s, e in sorted(runs):
        if out and out[-1][1] >= s:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "item_id", item_text: str = "text",
         text_col: str = "text", shard_bytes: int = SHARD_BYTES, max_span: int = MAX_SPAN, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """`docs` with n_words, max_match (words of the longest match with any item), hit_starts and hit_ends (runs of hit
    words, ends exclusive), hit_items (ids of the items with windows in the text) and cut_text (the text without its runs of
    more than `max_span` hit words; null if there is none)."""
    shards, automata = _automata(items, id_col, item_text, shard_bytes, window)

    def per_text(texts):
        sizes, longest = [0] * len(texts), [0] * len(texts)
        runs: list[list[list[int]]] = [[] for _ in texts]
        found: list[set] = [set() for _ in texts]
        any_shard = False
        for a in automata():
            any_shard = True
            for i, t in enumerate(texts):
                words = words_of(t)
                far, more, ids = a.scan(words)
                sizes[i], longest[i] = len(words), max(longest[i], far)
                runs[i] = _merged(runs[i] + more) if runs[i] and more else runs[i] or more
                found[i] |= ids
        if not any_shard:
            sizes = [len(words_of(t)) for t in texts]
        return [sizes, longest, [[s for s, _ in r] for r in runs], [[e for _, e in r] for r in runs], [sorted(i for i in f if i is not None) for f in found],
                [_cut(t, far).decode() if (far := [r for r in rs if r[1] - r[0] > max_span]) else None for t, rs in zip(texts, runs, strict=True)]]

    return add_columns(docs, text_col, FIELDS, per_text, chunk_bytes if shards > 1 else 0)


def n_hit() -> Column:
    return F.expr("aggregate(zip_with(hit_starts, hit_ends, (s, e) -> e - s), 0L, (a, x) -> a + x)")


def contaminated(max_share: int = MAX_SHARE) -> Column:
    return (n_hit() > 0) & (max_share * n_hit() >= F.col("n_words"))


def _cut(raw: bytes, runs: list[list[int]]) -> bytes:
    """The text without runs of words; one space stays where a run goes."""
    places = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for s, e in runs:
        out.append(raw[at:places[s][0]].rstrip(b" \t"))
        at = places[e - 1][1]
    out.append(raw[at:])
    return b" ".join(x for x in out if x)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_share: int = MAX_SHARE, max_span: int = MAX_SPAN,
          text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with the columns of `docs`; runs of more than `max_span` hit words are cut out of
    their texts. A column n_chars follows a text that is cut."""
    held = "__decontamination_"
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"{held}{i}") for i, c in enumerate(docs.columns)], F.col(f"`{text_col}`").alias("text"))
    found = scan(renamed, items, window, max_span=max_span).where(~contaminated(max_share))
    out = []
    for i, (c, kind) in enumerate(docs.dtypes):
        col = F.col(f"{held}{i}")
        if c == text_col:
            col = F.coalesce("cut_text", col)
        elif c == "n_chars":
            col = F.when(F.col("cut_text").isNull(), col).otherwise(F.char_length("cut_text").cast(kind))
        out.append(col.alias(c))
    return found.select(*out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: hit words and items of every document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go; long runs of hit words leave the texts of the others."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
        FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.n, dw.i, win.item FROM dw JOIN win USING (n, g)),
flags AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY 1),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN flags USING (doc_id) LEFT JOIN found USING (doc_id)
"""
