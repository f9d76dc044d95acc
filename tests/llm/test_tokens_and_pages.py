"""Tokenizer operators against the libraries, the token file format, HTML extraction, the pipeline and the registered queries."""

import hashlib
import html
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from odspark.llm import html_extraction, piece_model, sentencepiece_codec, token_counts, token_files
from odspark.llm.common import shared_folder, stored

from .conftest import texts

MODEL = piece_model.default_path("piece_bpe_32k.model")
BPE = piece_model.default_path("byte_bpe_50k.json")
ALPHABETS = ["abcdefgh ", "ab ", "theinrsao \n", "▁ =-._", "0123456789 ", "äöüßé  ́x", "aàα中字😀 \x07\n", "erntion"]


def odd_texts(n, seed=1):
    r = random.Random(seed)
    out = [t or "" for t in texts()] + [" ", "  a  b ", "a▁b", "\x00x", "<s>hi</s> <unk>", "'ll 's  x\n\n y", " " * 40 + "x", "aaaaaaaaaaaaaaaa", "=======----=====", "﻿q​"]
    for _ in range(n):
        a = r.choice(ALPHABETS)
        out.append("".join(r.choice(a) for _ in range(r.randint(0, 25))))
    return out


# ---- SentencePiece ----

def test_sentencepiece_ids_and_decoding_equal_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    e = sentencepiece_codec.encoder(MODEL)
    r = random.Random(2)
    pieces = ["".join(r.choice(e.pieces.text) for _ in range(r.randint(1, 6))).replace("▁", " ") for _ in range(3000)]
    for t in odd_texts(8000) + pieces:
        ids = sp.encode(t)
        joined, n, decoded = e.encode(t)
        assert (joined, n, decoded) == (",".join(map(str, ids)), len(ids), sp.decode(ids)), repr(t)
        assert e.decode(ids) == sp.decode(ids)


def test_decoding_of_broken_bytes_equals_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    e, r = sentencepiece_codec.encoder(MODEL), random.Random(4)
    for _ in range(2000):
        ids = [r.choice(e.pieces.byte_ids + [300, 400, 29871]) for _ in range(r.randint(0, 6))]
        assert e.decode(ids) == sp.decode(ids), ids


def test_sentencepiece_over_a_table(spark, docs, no_docs):
    out = sentencepiece_codec.encode(docs.withColumnRenamed("found", "n_tokens"))
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns.count("n_tokens") == 1
    assert all(len(r["token_ids"]) == r["n_tokens"] and r["decoded"] == (r["text"] or "") for r in rows)
    assert sentencepiece_codec.encode(no_docs).count() == 0


# ---- token counts ----

@pytest.mark.parametrize("byte_pieces", [True, False])
def test_counts_equal_the_unigram_library(byte_pieces):
    from tokenizers import Tokenizer, models

    scores = piece_model.load(MODEL).scores
    vocab = [("<unk>", 0.0), *scores.items(), *([(f"<0x{b:02X}>", 0.0) for b in range(256)] if byte_pieces else [])]
    library = Tokenizer(models.Unigram(vocab, 0, byte_pieces))
    mine = token_counts.Viterbi(scores, byte_pieces)
    for t in odd_texts(6000):
        marked = "▁" + t.replace(" ", "▁") if t else ""
        assert mine.count(t)[0] == len(library.encode(marked, add_special_tokens=False).ids), repr(t)


def test_viterbi_score_and_ties_by_brute_force():
    r = random.Random(9)
    for _ in range(300):
        scores = {"".join(r.choice("abc") for _ in range(r.randint(1, 3))): float(-r.randint(1, 4)) for _ in range(r.randint(1, 8))}
        v = token_counts.Viterbi(scores, False)
        text = "".join(r.choice("abcd") for _ in range(r.randint(1, 7)))
        paths = [(0.0, ())]
        best = {0: 0.0}
        for end in range(1, len(text) + 1):
            options = [best[s] + scores[text[s:end]] for s in range(end) if text[s:end] in scores]
            if text[end - 1] not in scores:
                options.append(best[end - 1] + v.unknown)
            best[end] = max(options)
        assert v.stretch(text)[1] == best[len(text)] and paths


def test_counts_over_a_table(docs, no_docs):
    rows = token_counts.count(docs).collect()
    assert len(rows) == docs.count() and all((r["n_tokens"] == 0) == (not r["text"]) for r in rows)
    assert token_counts.count(no_docs).count() == 0


# ---- token files ----

def test_shard_round_trip_and_damage():
    r = random.Random(1)
    docs = [(k * 3 - 5, np.array([r.randrange(50000) for _ in range(r.choice([0, 1, 5, 3000]))], "<u4").tobytes()) for k in range(50)]
    out = io.BytesIO()
    assert token_files.write_shard(out, iter(docs)) == (50, sum(len(b) for _, b in docs) // 4)
    raw = out.getvalue()
    shard = token_files.Shard(io.BytesIO(raw))
    assert list(shard.doc_ids) == [d for d, _ in docs] and [shard.ids(k) for k in range(50)] == [b for _, b in docs]
    # any zstandard reader skips the tables and gives all ids in order
    import zstandard
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == b"".join(b for _, b in docs)
    k = max(range(50), key=lambda i: len(docs[i][1]))
    broken = bytearray(raw)
    broken[int(shard.starts[k]) + 40] ^= 255
    with pytest.raises(Exception):  # noqa: B017
        token_files.Shard(io.BytesIO(bytes(broken))).ids(k)
    other = (k + 1) % 50
    assert token_files.Shard(io.BytesIO(bytes(broken))).ids(other) == docs[other][1]


def test_pretoken_memo_equals_whole_texts():
    e = token_files.encoder(BPE)
    for t in odd_texts(4000, 5) + ["a<|endoftext|> b", "x  \n\n 's"]:
        assert e.encode(t) == e.whole(t), repr(t)


def test_token_files_over_a_table(spark, docs, no_docs):
    from tokenizers import Tokenizer

    folder = shared_folder(spark, "test-token-files")
    shards = stored(token_files.write(docs, folder, shard_bytes=4000), "test-shards")
    assert shards.count() > 1
    got = token_files.read(spark, shards, folder).orderBy("start").collect()
    assert len(got) == docs.count() and [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda x: -1 if x is None else x)
    library, at = Tokenizer.from_file(BPE), 0
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids) + (2,)) for r in docs.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += len(r["ids"])
    crc = {r["start"]: r["ids_crc32"] for r in token_files.read_digests(spark, shards, folder).collect()}
    assert all(crc[r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    first = shards.orderBy("shard").collect()[-1]
    last = got[-1]
    assert token_files.read_documents(folder, first["file"], [last["doc_id"]])[last["doc_id"]][-1] == 2
    empty = shared_folder(spark, "test-token-files")
    assert token_files.read(spark, stored(token_files.write(no_docs, empty), "test-shards"), empty).count() == 0


# ---- HTML extraction ----

def exact_marginals(score, parent, pair):
    """By all assignments."""
    n, psi = len(score), np.array(pair).reshape(2, 2)
    total, ones = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [(bits >> v) & 1 for v in range(n)]
        w = np.exp(sum(score[v] for v in range(n) if y[v]) + sum(psi[y[parent[v]], y[v]] for v in range(n) if parent[v] >= 0))
        total += w
        ones += w * np.array(y)
    return ones / total


def test_message_passing_by_enumeration():
    r = np.random.default_rng(1)
    for _ in range(40):
        n = int(r.integers(1, 9))
        parent = np.array([-1] + [int(r.integers(0, v)) for v in range(1, n)])
        depth = np.zeros(n, int)
        for v in range(1, n):
            depth[v] = depth[parent[v]] + 1
        score, pair = r.normal(size=n) * 2, r.normal(size=4)
        got, both = html_extraction.marginals(score, parent, depth, pair)
        assert np.allclose(got, exact_marginals(score, parent, pair))
        assert all(np.isclose(both[v].sum(), 1) and np.isclose(both[v][:, 1].sum(), got[v]) for v in range(1, n))


def test_held_out_pages():
    pages, right, total = html_extraction.PAGES, 0, 0
    for k in range(0, len(pages), 4):
        w = html_extraction.train(pages[:k] + pages[k + 1:])
        page = html_extraction.parse(pages[k])
        y = html_extraction.labels(page)
        parent, depth = html_extraction.forest([page])
        p, _ = html_extraction.marginals(html_extraction.features(page) @ np.array(w.unary), parent, depth, w.pair)
        nodes = {n for n, _ in page.blocks}
        right, total = right + sum((p[v] >= 0.5) == y[v] for v in nodes), total + len(nodes)
    assert right >= 0.93 * total


@pytest.mark.parametrize("page, want", [
    ("", ""), ("<html>", ""), ("<article><h1>A &amp; b</h1><p>One\n two&nbsp;<b>three</b>.<br>Four.<p>Five", "A & b\n\nOne two three. Four.\n\nFive"),
    ("<nav><a href=/>Home</a></nav><article><p>Text &lt;b&gt; here.</p><script>var t='</p>';</script><!-- no --><p>More.</p></article><footer>&copy; x</footer>", "Text <b> here.\n\nMore."),
    ("<article><p>cut off &eacute; <a href='x", "cut off é"),
])
def test_small_pages(page, want):
    assert html_extraction.extract_batch([page], html_extraction.train()) == [want]


@pytest.mark.parametrize("between", [
    "<svg-icon name=x></svg-icon>", "<svg class=i />", "<svg class='i'/>", "<iframe src=x />", "<svg class=i>", "<iframe src=x>", "<object data=x>", "<canvas>",
    "<svg><path d='M0'/><svg><text>no</text></svg><title/><text>no</text></svg>", "<svg class=i /><svg><text>no</text></svg>", "<svg class=i><svg><text>no</text></svg>",
    "<svg><style>a</style><script>'</svg>'</script><!-- </svg> --><text>no</text></svg>", "<IFRAME src=http://x/>no</iframe>", "<svg" + " a" * 9, "<noscript><img src=x>no</noscript>",
])
def test_hidden_elements_end_where_they_end(between):
    page = f"<article><h1>A head of it</h1><p>One is the first of all numbers.</p>{between}{'>' * (between[-1] == 'a')}<p>Two comes after it, as all know.</p></article>"
    want = "A head of it\n\nOne is the first of all numbers.\n\nTwo comes after it, as all know."
    weights = html_extraction.train()
    assert html_extraction.extract_batch([page], weights) == [want]
    later = "<footer><svg class=j><text>no</text></svg><iframe src=y></iframe></footer>"
    assert html_extraction.extract_batch([page + later], weights) == [want]


def test_math_keeps_its_text_and_many_unclosed_elements_take_one_pass():
    page = "<article><p>One is <math><mrow><mi>x</mi><mspace/><mo>=</mo><mn>2</mn></mrow></math> here, as <math/>they say.</p><p>Two is the next of them.</p></article>"
    assert html_extraction.extract_batch([page], html_extraction.train()) == ["One is x=2 here, as they say.\n\nTwo is the next of them."]
    many = html_extraction.parse("<p>a</p>" + "<svg>" * 30000 + "<iframe><canvas>" * 30000 + "<p>b</p>")
    assert [t for _, t in many.blocks] == ["a", "b"]
    assert [t for _, t in html_extraction.parse("<svg>a" + "<style>" * 30000).blocks] == ["a"]


def test_extraction_of_the_pages_table(spark):
    """Against the article element of the table's own layout, cut at its block tags."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "y"), (1, "u", "<p" * 50000, "z")], "page_id long, url string, html string, text string")
    assert sorted(html_extraction.extract(odd).select("n_chars").toPandas()["n_chars"]) == [0, 0, 0]
    rows = html_extraction.extract(pages).collect()
    assert len(rows) == pages.count()
    wrong = 0
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inner)]
        wrong += r["text"] != "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])
    assert wrong <= 0.01 * len(rows)


# ---- pipeline and registered queries ----

def test_registered_queries_and_guard():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
    assert {"op1_decontamination", "op2_ngram_jaccard_join", "op3_secret_scan", "op5_license_scan", "op10_url_filter"} <= set(entry.oracle_sql())


def test_queries_without_sql_by_brute_force(spark):
    import sentencepiece

    from odspark.llm import quality_rules
    from .test_rules_and_scans import brute_statistics

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: r for r in sentencepiece_codec.query(spark, sf).collect()}
    for i, t in docs.items():
        ids = sp.encode(t)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), digest(",".join(map(str, ids))), digest(sp.decode(ids)))
    for r in quality_rules.query(spark, sf).collect():
        s = brute_statistics(docs[r["doc_id"]])
        assert s == tuple(r[c] for c in quality_rules.BASE_COLUMNS) and r["base_failed"] == (s[0] < 10 or 100 * s[4] > 20 * s[0]) and not (r["kept"] and r["base_failed"])


def test_pipeline_stages_by_brute_force(spark):
    """Each stage on its own input: what leaves, what stays, what changes."""
    import sentencepiece

    import corpus_pipeline
    from odspark.llm import decontamination, quality_rules, secret_scan
    from .test_joins_and_contamination import brute_components, brute_hits
    from .test_rules_and_scans import brute_spans, brute_statistics

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard_join", "decontamination", "secret_scan", "sentencepiece"]
    rows = lambda df: {r["doc_id"]: r for r in df.collect()}

    one = stored(stages["quality_rules"](spark, docs, sf), "one")
    assert one.columns == columns
    rules = quality_rules.learn(quality_rules.labelled_rows(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    for i, r in rows(docs).items():
        s = brute_statistics(r["text"])
        if s[0] < 10 or 100 * s[4] > 20 * s[0]:
            assert i not in rows(one.where(f"doc_id = {i}"))
    assert rows(one).keys() == {r["doc_id"] for r in quality_rules.statistics(docs).withColumn("rule", quality_rules.verdict(rules)).withColumn("b", quality_rules.base_failed()).where("rule = 0 AND NOT b").collect()}

    two = stored(stages["ngram_jaccard_join"](spark, one, sf), "two")
    assert two.columns == columns
    want = {i for i, _, c in brute_components([(i, r["text"]) for i, r in rows(one).items()]) if i == c}
    assert rows(two).keys() == want

    three = stored(stages["decontamination"](spark, two, sf), "three")
    assert three.columns == columns
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    after = rows(three)
    for i, r in rows(two).items():
        words = decontamination.words_of((r["text"] or "").encode())
        hit, _ = brute_hits(items, words, 13) if len(words) < 1500 else (None, None)
        if hit is not None:
            assert (i not in after) == (len(hit) > 0 and 20 * len(hit) >= len(words))
            if not hit:
                assert after[i] == r

    four = stored(stages["secret_scan"](spark, three, sf), "four")
    assert four.columns == columns
    end = rows(four)
    assert end.keys() == after.keys()
    for i, r in after.items():
        spans = brute_spans(r["text"], secret_scan.RULES)
        assert (end[i] == r) == (spans == "") and brute_spans(end[i]["text"], secret_scan.RULES) == ""

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    last = rows(stages["sentencepiece"](spark, four, sf))
    assert last.keys() == end.keys() and all(last[i]["token_ids"] == sp.encode(end[i]["text"]) for i in end)


def test_pages_with_many_open_elements_and_stray_ends():
    import time
    n = 60_000
    for page in ("<div><b>" * n + "</i></span>" * n, "<b>" * n + "<table>" + "</b>" * n, "<p>" + "<div>" * n + "x" * 10):
        began = time.time()
        html_extraction.parse(page)
        assert time.time() - began < 10


def test_parts_between_spaces_encode_like_whole_texts():
    import random
    from odspark.llm import token_files
    from odspark.llm.piece_model import default_path
    e = token_files.Encoder(default_path(token_files.TOKENIZER))
    r = random.Random(3)
    alphabet = ["a", "b", "Zq", "'s", "'", " ", " ", "  ", "\n", "\t", "é", "1", "22", ".", "!", "\u00a0", "\u2003", "日", "😀", "don't", "\x1f", "-"]
    for _ in range(4000):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(0, 14)))
        assert e.encode(t) == e.whole(t), repr(t)


def test_many_texts_at_once_encode_like_whole_texts():
    import pyarrow as pa

    r = random.Random(23)
    parts = ["a", "b", " ", "  ", "\n", "é", "e\u0301", "漢", "'s", "'", "1", "٣", ".", "<|endoftext|>", "\u00a0", "\u3000", "\t", "don't", " word", "🙂", "\x1c"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 14))) for _ in range(5000)] + ["", " ", "  ", "a ", " a", "x" * 5000 + " y" + "z" * 5000]
    e = token_files.Encoder(BPE)
    # a small memo forgets between and inside the calls
    e.after.limit = e.pre_tokens.limit = e.start.limit = 4000
    want = [e.whole(t) for t in texts]
    for n in (len(texts), 700):
        assert [ids for k in range(0, len(texts), n) for ids in e.encode_all(pa.array(texts[k:k + n]))] == want
    assert [e.encode(t) for t in texts] == want
    assert e.encode_all(pa.array([], pa.string())) == []
    assert e.encode_all(pa.array(["<|endoftext|>", "a \n"])) == [e.whole("<|endoftext|>"), e.whole("a \n")]
