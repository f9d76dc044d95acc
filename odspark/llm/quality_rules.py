"""Quality rules (op 9): a decision list learned from labelled statistics.

Per document a projection of built-in functions gives the text statistics; no shuffle. Sequential
covering learns an ordered list of rules that reject: each rule is a conjunction of threshold tests, grown
test by test on two thirds of the labelled rows (best information gain) and pruned from its end on the other
third. A rule that is not precise enough is thrown away with the feature it starts with. The list becomes one ordered chain of
Spark conditional expressions, so applying it stays inside the scan.

Defined cases: a null text counts as empty (no words; base_failed); a null or repeated doc_id is kept row by row;
labels of one document that differ count as bad (quality 0); null labels are left out; with no labels, or labels of one kind,
the list is empty and only the base rule rejects. Extra columns of the input are passed through by `filter_documents` and
never clash: the statistics live in one struct column with a name of its own.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.llm.common import SPACE_CHARS, space_words, table, text_or_empty

#: Bound of the labelled rows that the rules are learned from (taken in the order of a hash of doc_id).
MAX_LABELLED = 8192
#: Fixed parameters of the learner.
N_THRESHOLDS = 24      # candidate thresholds per feature: quantiles of the sample
MIN_COVER = 5          # labelled bad documents that a rule covers at least, growing and pruning rows together
MIN_PRECISION = 0.95   # share of bad documents among those that a rule rejects, on the pruning rows
MAX_RULES, MAX_TESTS = 12, 4

#: Features of the decision list: a name and its expression over the statistics.
FEATURES = {
    "words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "bang_per_word": "n_bang / greatest(n_words, 1)",
}
BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STAT_COLUMNS = [*BASE_COLUMNS, "n_lines", "n_bang"]
#: Name of the helper column; inputs do not use it.
HELD = "__quality_rules"


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool          # True: feature > threshold, False: feature <= threshold
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.threshold) is self.above


Rule = tuple[Test, ...]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with one struct column HELD of text statistics (STAT_COLUMNS).

    Each step is a column of its own (not a field of a struct, which the optimizer would take apart and compute repeatedly).
    """
    t, signs, w, hashes, win, lines, s, p = (f"{HELD}_{x}" for x in ("text", "signs", "words", "hashes", "windows", "lines", "sorted", "places"))
    out = docs.withColumn(t, text_or_empty(text_col))
    out = out.withColumn(signs, F.regexp_replace(F.col(t), r"[^#*$%&|<>!]+", ""))
    out = out.withColumn(w, space_words(F.col(t)))
    out = out.withColumn(lines, F.filter(F.split(F.col(t), "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""))
    # 5-word windows by 64-bit hash, compared within one text only
    out = out.withColumn(hashes, F.expr(f"transform({w}, x -> xxhash64(x))"))
    out = out.withColumn(win, F.expr(
        f"CASE WHEN size({w}) >= 5 THEN transform(arrays_zip({', '.join(f'slice({hashes}, {k}, size({w}) - 4)' for k in range(1, 6))}), "
        "x -> xxhash64(x)) ELSE array() END"))
    # windows of the texts that repeat any, sorted with their places; then the places of those found twice or more
    out = out.withColumn(s, F.expr(
        f"CASE WHEN size(array_distinct({win})) < size({win}) THEN sort_array(transform({win}, "
        "(x, i) -> named_struct('w', x, 'i', i))) ELSE array() END"))
    out = out.withColumn(p, F.expr(
        f"sort_array(filter(transform({s}, (x, j) -> IF(x.w = get({s}, j - 1).w OR x.w = get({s}, j + 1).w, x.i, NULL)), "
        "p -> p IS NOT NULL))"))
    repeat = F.expr(f"aggregate({p}, named_struct('last', -5, 'n', 0L), "
                    "(a, p) -> named_struct('last', p, 'n', a.n + least(5, p - a.last)), a -> a.n)")
    # generated, not projected: a filter on the statistics is then not pushed below them, which would compute them repeatedly
    stats = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", F.col(w))).cast("long").alias("word_chars"),
        F.char_length(F.replace(F.col(signs), F.lit("!"), F.lit(""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat.cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.char_length(signs) - F.char_length(F.replace(F.col(signs), F.lit("!"), F.lit("")))).cast("long").alias("n_bang"),
    )
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(stats)).alias(HELD))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col and STAT_COLUMNS."""
    return with_statistics(docs.select(id_col, text_col), text_col).select(id_col, f"{HELD}.*")


def labelled_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[dict]:
    """Feature values and label of at most `max_labelled` labelled documents, always the same ones."""
    one = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    picked = docs.select("doc_id", "text").join(F.broadcast(one), "doc_id")  # bounded by max_labelled
    stats = with_statistics(picked).select("doc_id", "quality", f"{HELD}.*")
    rows = stats.select("doc_id", "quality", *[F.expr(f"CAST({e} AS DOUBLE)").alias(k) for k, e in FEATURES.items()])
    # repeated documents could exceed the bound; the order is total, so the sample is the same on every run
    return [r.asDict() for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(max_labelled).collect()]


def _thresholds(rows: list[dict]) -> dict[str, list[float]]:
    out = {}
    for f in FEATURES:
        values = sorted({r[f] for r in rows})
        step = max(1, len(values) // N_THRESHOLDS)
        # halfway between neighbouring values; the ends, where rules separate best, are always tried
        cuts = sorted({*range(0, len(values) - 1, step), 0, 1, 2, 3, len(values) - 2, len(values) - 3})
        out[f] = [(values[i] + values[i + 1]) / 2 for i in cuts if 0 <= i < len(values) - 1]
    return out


def _counts(rows: list[dict]) -> tuple[int, int]:
    bad = sum(r["quality"] == 0 for r in rows)
    return bad, len(rows) - bad


def _grow(rows: list[dict], cuts: dict[str, list[float]]) -> Rule:
    rule: list[Test] = []
    while len(rule) < MAX_TESTS:
        bad, good = _counts(rows)
        if not bad or not good:
            break
        base, best = math.log2(bad / (bad + good)), (1e-9, None)
        for f, thresholds in cuts.items():
            order = sorted((r[f], r["quality"] == 0) for r in rows)
            at, low_bad = 0, 0
            for t in thresholds:
                while at < len(order) and order[at][0] <= t:
                    low_bad += order[at][1]
                    at += 1
                for above, b, n in ((False, low_bad, at), (True, bad - low_bad, len(order) - at)):
                    if b:
                        gain = b * (math.log2(b / n) - base)
                        if gain > best[0]:
                            best = (gain, Test(f, above, t))
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [r for r in rows if best[1].holds(r)]
    return tuple(rule)


def _covers(rule: Rule, row: dict) -> bool:
    return all(t.holds(row) for t in rule)


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """The prefix of the rule with the highest (bad - good) / (bad + good) on the pruning rows; the shorter one on a tie."""
    best = (-2.0, rule)
    for k in range(1, len(rule) + 1):
        bad, good = _counts([r for r in rows if _covers(rule[:k], r)])
        value = (bad - good) / (bad + good) if bad + good else -1.0
        if value > best[0]:
            best = (value, rule[:k])
    return best[1]


def learn(rows: list[dict]) -> list[Rule]:
    """The ordered rules learned by sequential covering; every row holds FEATURES and `quality`."""
    growing, pruning = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if i % 3 == 0]
    cuts, rules = _thresholds(growing), []
    while len(rules) < MAX_RULES:
        grown = _grow(growing, cuts)
        if not grown:
            break
        rule = _prune(grown, pruning)
        bad, good = _counts([r for r in pruning if _covers(rule, r)])
        grown_bad, grown_good = _counts([r for r in growing if _covers(rule, r)])
        if bad + grown_bad < MIN_COVER or not bad or bad < MIN_PRECISION * (bad + good) or grown_bad < MIN_PRECISION * (grown_bad + grown_good):
            del cuts[grown[0].feature]  # no precise rule starts with this feature; try the others
            continue
        rules.append(rule)
        growing = [r for r in growing if not _covers(rule, r)]
        pruning = [r for r in pruning if not _covers(rule, r)]
    return rules


def rule_sql(rule: Rule) -> str:
    return " AND ".join(t.sql() for t in rule)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects (from 1), 0 if none does: an ordered conditional expression over the statistics."""
    cases = " ".join(f"WHEN {rule_sql(rule)} THEN {k}" for k, rule in enumerate(rules, 1))
    return F.expr(f"CASE {cases} ELSE 0 END" if rules else "0")


def base_failed() -> Column:
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def judge(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document: doc_id, all statistics, base_failed, rule (first rejecting rule, 0 if none) and kept."""
    rules = learn(labelled_rows(docs, labels, max_labelled))
    return (statistics(docs).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def filter_documents(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of `docs` that are kept, with the columns of `docs`."""
    rules = learn(labelled_rows(docs, labels, max_labelled))
    held = with_statistics(docs)
    rejects = " OR ".join(["n_words < 10", "100 * n_repeat_words > 20 * n_words", *[f"({rule_sql(r)})" for r in rules]])
    return held.where(f"NOT ({_qualified(rejects)})").select(*docs.columns)


def _qualified(sql: str) -> str:
    """Statistics named inside the helper struct, so that columns of the input with the same names do not clash."""
    return re.sub(rf"\b({'|'.join(STAT_COLUMNS)})\b", rf"{HELD}.\1", sql)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: statistics, base rule and verdict of every document."""
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *BASE_COLUMNS, "base_failed", "kept", "rule")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    return filter_documents(docs, table(spark, sf_dir, "labels"))
