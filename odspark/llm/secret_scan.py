"""Secret scans (op 3): a trigram index narrows each rule to candidate documents, which its regular expression then verifies.

From the parse tree of every rule's regular expression a Boolean trigram query is derived: a conjunction of clauses, each a choice of
strings whose trigrams a matching text must all hold. The inverted index lists, for each trigram that any query names, the documents
that hold it; postings are intersected within alternatives and over clauses. Candidates are verified by the expression on the whole text; rules
whose expression has no mandatory trigram (`hex`) scan every text. Built from DataFrame and SQL functions only.

Spans are code points of the text, end exclusive: the matches of a rule are leftmost and do not overlap; matches whose counted part is shorter
than the rule's least length are dropped afterwards. Spans of different rules may overlap; all stay.

Defined cases: a null text counts as empty; documents without id or with equal ids are scanned row by row (their candidates are pooled, which the
verification undoes); a text without secrets has counts 0 and empty span strings. Extra columns pass through `redact`.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.llm.common import table, text_or_empty


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str       # Java, Python and RE2 read it alike
    least: int = 1     # least length of the group, in code points
    group: int = 0     # group whose length counts
    any_case: bool = False
    long: str = ""     # an expression that matches exactly the long enough matches of `pattern`, where there is one


# The base rules of the contract, in its order, then public token formats of the method's own. A match of `hex` or `access` takes the whole run of
# its letters, so a short one hides no long one and the least length can stand in the expression; in `assign` a short match can hide a long one.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20, long=r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", 24, long=r"[0-9a-f]{24,}"),
]
EXTRA = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
]
RULES = [*BASE, *EXTRA]
MAX_CHOICES = 64   # most strings that a part of an expression is expanded to before its trigrams are taken


# ---- Boolean trigram queries from regular expressions ----

#: A clause: alternatives, each a set of lower-case trigrams; a matching text holds all trigrams of one alternative.
Clause = frozenset[frozenset[str]]


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold for the lower-cased text around any match of the expression; [] if it has no mandatory trigram."""
    import re._parser as parser

    clauses: list[Clause] = []

    def strings(node) -> list[str] | None:
        """All strings (lower-cased) that a node matches, if they are few; None otherwise."""
        op, arg = str(node[0]), node[1]
        if op == "LITERAL":
            return [chr(arg).lower()]
        if op == "IN":
            out = set()
            for k, v in arg:
                if str(k) not in ("LITERAL", "RANGE") or str(k) == "RANGE" and v[1] - v[0] >= MAX_CHOICES:
                    return None
                out |= {chr(c).lower() for c in (range(v[0], v[1] + 1) if str(k) == "RANGE" else [v])}
            return sorted(out) if len(out) <= 8 else None
        if op == "SUBPATTERN":
            return product_of(arg[3])
        if op == "BRANCH":
            parts = [product_of(x) for x in arg[1]]
            return None if any(x is None for x in parts) else sorted({y for x in parts for y in x})
        if op == "MAX_REPEAT" and arg[1] <= 3:
            inner = product_of(arg[2])
            return None if inner is None else sorted({"".join(x) for k in range(arg[0], arg[1] + 1) for x in product(inner, repeat=k)})
        return None

    def product_of(nodes) -> list[str] | None:
        out = [""]
        for node in nodes:
            part = strings(node)
            if part is None or len(out) * len(part) > MAX_CHOICES:
                return None
            out = sorted({x + y for x in out for y in part})
        return out

    def close(run: list[str]) -> None:
        if all(len(x) >= 3 for x in run):
            clauses.append(frozenset(frozenset(x[i:i + 3] for i in range(len(x) - 2)) for x in run))

    run = [""]
    for node in parser.parse(pattern):
        part = None if str(node[0]) == "MAX_REPEAT" and node[1][0] == 0 else strings(node)  # optional parts end a run
        if part is not None and len(run) * len(part) <= MAX_CHOICES:
            run = sorted({x + y for x in run for y in part})
        else:
            close(run)
            run = part or [""]
    close(run)
    return list(dict.fromkeys(clauses))


# ---- index and postings ----

def _lower(text: Column) -> Column:
    """ASCII letters in lower case; other characters, whose case no rule looks at, may change too."""
    return F.lower(text)


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Inverted index over the wanted trigrams: (trigram, doc_id), one row per trigram that a text holds."""
    low = docs.select(F.col(id_col).alias("doc_id"), _lower(text_or_empty(text_col)).alias("low"))
    held = F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams])
    return low.select("doc_id", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kinds): the rules whose trigram queries a document's postings satisfy."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {k: q for k, q in queries.items() if q}
    terms = [(k, n, a, len(alt), t) for k, q in queries.items() for n, clause in enumerate(q)
             for a, alt in enumerate(sorted(map(sorted, clause))) for t in alt]
    values = ", ".join(f"('{k}', {n}, {a}, {size}, {_sql(t)})" for k, n, a, size, t in terms)
    wanted = docs.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(kind, clause, alternative, size, trigram)")
    sizes = F.create_map(*[F.lit(x) for k, q in queries.items() for x in (k, len(q))])
    index = postings(docs, sorted({t[-1] for t in terms}), id_col, text_col).distinct()
    # an alternative is met by all of its trigrams, a clause by any alternative, a query by all of its clauses
    met = (index.join(F.broadcast(wanted), "trigram").groupBy("doc_id", "kind", "clause", "alternative", "size").agg(F.count("*").alias("n"))
           .where("n = size").groupBy("doc_id", "kind").agg(F.count_distinct("clause").alias("n")))
    return met.where(F.col("n") == sizes[F.col("kind")]).groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# ---- verification ----

BLOCK = 256        # matches whose places are found in one pass over a growing array


def matches(text: str, rule: Rule) -> str:
    """SQL: array of (s, k, e) of a rule's matches in `text`. Places follow from the pieces between the matches, block by block, so that the
    array that grows in a pass stays short and the work is in proportion to the matches."""
    pattern = _sql(("(?i)" if rule.any_case else "") + (rule.long or rule.pattern))
    found, pieces = f"regexp_extract_all({text}, {pattern}, 0)", f"split({text}, {pattern}, -1)"
    counted = found if not rule.group else f"regexp_extract_all({text}, {pattern}, {rule.group})"
    order = [r.kind for r in RULES].index(rule.kind)
    # match, piece before it, counted group: as lengths
    lengths = f"transform(arrays_zip({found}, slice({pieces}, 1, size({found})), {counted}), x -> named_struct('m', char_length(x.`0`), 'p', char_length(x.`1`), 'n', char_length(x.`2`)))"
    one = "CAST(array() AS array<struct<s:int,k:int,e:int,n:int>>)"
    block = (f"aggregate(slice(z, b * {BLOCK} + 1, {BLOCK}), named_struct('at', a.at, 'out', {one}), (c, x) -> named_struct('at', c.at + x.p + x.m, 'out', "
             f"IF(x.n >= {rule.least}, array_append(c.out, named_struct('s', c.at + x.p, 'k', {order}, 'e', c.at + x.p + x.m, 'n', x.n)), c.out)))")
    step = f"element_at(transform(array({block}), y -> named_struct('at', y.at, 'out', array_append(a.out, y.out))), 1)"
    blocks = (f"aggregate(sequence(0, CAST(ceil(size(z) / {BLOCK}) AS INT)), named_struct('at', 0, 'out', CAST(array() AS array<array<struct<s:int,k:int,e:int,n:int>>>)), "
              f"(a, b) -> {step}, a -> flatten(a.out))")
    return f"element_at(transform(array({lengths}), z -> {blocks}), 1)"


def scan(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with a column `secrets`: array of (s, k, e, n) by start, then rule: start, place of the rule in RULES, end, counted length."""
    rules = RULES if rules is None else rules
    ids = candidates(docs, rules, id_col, text_col).select(F.col("doc_id").alias("__secret_id"), F.col("kinds").alias("__secret_kinds"))
    joined = docs.join(ids, F.col(f"`{id_col}`").eqNullSafe(F.col("__secret_id")), "left").withColumn("__secret_text", text_or_empty(text_col))
    empty = "CAST(array() AS array<struct<s:int,k:int,e:int,n:int>>)"
    parts = []
    for r in rules:
        found = matches("__secret_text", r)
        if trigram_query(r.pattern):
            parts.append(f"CASE WHEN array_contains(__secret_kinds, '{r.kind}') THEN {found} ELSE {empty} END")
        else:
            # no mandatory trigram: every text is scanned; one pass tells whether there is any match long enough
            parts.append(f"CASE WHEN __secret_text RLIKE {_sql(r.long or r.pattern)} THEN {found} ELSE {empty} END")
    out = joined.withColumn("secrets", F.expr(f"sort_array(concat({', '.join(parts)}))"))
    return out.drop("__secret_id", "__secret_kinds", "__secret_text")


def spans_text(secrets: Column, kinds: list[str]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(secrets, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` (columns of any names) with every secret span replaced by `mark` (overlapping spans as one); a column n_chars follows a text that changes."""
    names = docs.columns
    held = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text_at = f"c{names.index(text_col)}"
    found = scan(held, id_col=f"c{names.index(id_col)}", text_col=text_at)
    text = f"coalesce(CAST({text_at} AS string), '')"
    # pieces that stay lie before, between and after the merged spans
    merged = (f"aggregate(secrets, named_struct('at', 0, 'out', CAST(array() AS array<string>)), (a, x) -> CASE WHEN x.s >= a.at THEN named_struct('at', x.e, 'out', "
              f"array_append(a.out, concat(substring({text}, a.at + 1, x.s - a.at), {_sql(mark)}))) ELSE named_struct('at', greatest(a.at, x.e), 'out', a.out) END, "
              f"a -> concat(array_join(a.out, ''), substring({text}, a.at + 1)))")
    new = F.when(F.size("secrets") == 0, F.col(text_at)).otherwise(F.expr(merged))
    out = found.withColumn("new_text", new)
    columns = []
    for i, (c, kind) in enumerate(docs.dtypes):
        col = F.col(f"c{i}")
        if c == text_col:
            col = F.col("new_text")
        elif c == "n_chars":
            col = F.when(F.size("secrets") == 0, col).otherwise(F.char_length("new_text").cast(kind))
        columns.append(col.alias(c))
    return out.select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: counts and spans of the secrets of every document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in RULES]
    base = F.filter("secrets", lambda x: x["k"] < len(BASE))
    count = lambda k: F.size(F.filter("secrets", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)],
        F.sha2(spans_text(base, kinds), 256).alias("base_sha256"), spans_text(F.col("secrets"), kinds).alias("spans"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are replaced by a mark; all documents stay."""
    return redact(docs)


def _oracle() -> str:
    """DuckDB: every rule scans every text; places from the pieces between the matches."""
    parts = []
    for k, r in enumerate(RULES):
        p = ("(?i)" if r.any_case else "") + r.pattern.replace("'", "''").replace("{36,255}", "{36,255}")
        parts.append(
            f"SELECT doc_id, {k} AS k, '{r.kind}' AS kind, list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s, "
            f"ms[i] AS m, gs[i] AS g FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, "
            f"regexp_extract_all(t, '{p}', {r.group}) AS gs, string_split_regex(t, '{p}') AS ps FROM d WHERE regexp_matches(t, '{p}')))")
    union = " UNION ALL ".join(parts)
    least = " ".join(f"WHEN {k} THEN {r.least}" for k, r in enumerate(RULES))
    counts = ", ".join(f"count(*) FILTER (k = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({union}),
f AS (SELECT doc_id, k, kind, CAST(s AS BIGINT) AS s, CAST(s + length(m) AS BIGINT) AS e FROM m WHERE length(g) >= CASE k {least} END),
a AS (SELECT doc_id, {counts}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS base,
      string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM f GROUP BY 1)
SELECT d.doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""


ORACLE = _oracle()
