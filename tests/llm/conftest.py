import random

import pytest

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, label string, found string, row string, w string, kinds string"


def brute_words(text):
    import re
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def space_words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts():
    """Null, empty, tiny, long, repeated and odd texts."""
    r = random.Random(7)
    vocab = ["the", "river", "Gate", "été", "of", "x1", "größe", "word.", "a-b", "日本", "😀", "no"]
    body = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    long = body(9000)
    copy = " ".join(f"w{k}" for k in range(200))
    return [None, "", " \n\t ", "one", "two words", "Copy " + copy, copy, copy, copy.replace("w7 ", "v7 "), copy.replace("w90 ", ""), long, long + " end", body(40),
            "same line\nsame line\nother\n\nsame line", "a b c d e f a b c d e f", "#*$%&|<> !!", "tab\tand\x0bvt\x0cff\rcr", "THE END OF IT", body(12), "x " * 50]


@pytest.fixture(scope="session")
def docs(spark):
    """Small documents table: ids with a null and repeats, whole rows repeated, extra columns with clashing names."""
    rows = [(None if k == 3 else k, t, "en", "src0", None if t is None else len(t), "clash", None, "f", "r", "w", "k") for k, t in enumerate(texts())]
    rows += [rows[6], (6, "another text under a known id", "en", "src1", 29, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EXTRA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EXTRA)
