"""SentencePiece encoding and decoding (op 8): exact merge-type encoding by backtracking, in Arrow batches without a shuffle.

The library merges neighbouring symbols, best score first, leftmost first among equals. The same tokens follow without a merge queue: an
Aho-Corasick automaton over the pieces lists the matches at every place; from the left the longest match is taken that is compatible with the token before it;
when none fits, the last token is taken back and its end is marked in a bitfield of failed positions. Two neighbours are compatible when undoing
their own merges across the seam, last merge first, never shows a merge over the seam that would have come earlier.

No piece holds a word start after another character, and characters that are no piece never merge, so a text falls into independent stretches
(spaces before a word and the word). Each worker remembers the tokens of short stretches (bounded in bytes), until it is given to another operator.

Defined cases: a null text counts as empty and has no tokens; documents without id or with equal ids are encoded row by row. Characters that are no piece become their
UTF-8 byte pieces. Extra columns pass through `encode`; its added columns replace columns of the same names.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.llm.common import Memo, add_columns, held, table
from odspark.llm.piece_model import SPACE, Pieces, default_path, load

MODEL = "piece_bpe_32k.model"
PAIRS = 200_000       # neighbours whose compatibility one Python worker remembers
FAR = 1 << 60


class Encoder:
    """Merge-type encoder of one model. Tokens are strings; ranks order merges, the earliest first."""

    def __init__(self, pieces: Pieces):
        import ahocorasick

        self.pieces, self.ids = pieces, pieces.ids
        # equal scores: the merge further left comes first, which the seam check decides; ranks are equal then
        self.rank = {p: -s for p, s in pieces.scores.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces with a word start inside are not supported")
        self.machine = ahocorasick.Automaton()
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.usable: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        # only pieces that their own characters merge into can be tokens
        for p in sorted(self.ids, key=len):
            if len(p) == 1:
                self.parts[p], self.usable[p] = None, True
            else:
                whole, last = self._merge(p)
                self.usable[p], self.parts[p] = whole, last
            if self.usable[p]:
                self.machine.add_word(p, len(p))
        self.machine.make_automaton()
        # length of the longest shorter piece that a piece begins with
        self.shorter = {p: next((k for k in range(len(p) - 1, 0, -1) if self.usable.get(p[:k]) or k == 1), 0) for p in self.ids if len(p) > 1}
        # decoded text of every id; None: a byte piece, decoded together with its neighbours
        self.plain = [" \u2047 " if i == pieces.unknown else p.replace(SPACE, " ") if p in self.ids else "" for i, p in enumerate(pieces.text)]
        for i in pieces.byte_ids:
            self.plain[i] = None
        self.byte_of = {i: b for b, i in enumerate(pieces.byte_ids)}
        self.pattern = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if any("\n" in p for p in self.ids) else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.memo = Memo(self._ids)

    def _merge(self, piece: str) -> tuple[bool, tuple[str, str] | None]:
        """Whether merging the characters of a piece gives the piece, and the two parts of its last merge."""
        symbols, last = list(piece), None
        while len(symbols) > 1:
            best = min(((self.rank[symbols[i] + symbols[i + 1]], i) for i in range(len(symbols) - 1) if symbols[i] + symbols[i + 1] in self.rank), default=None)
            if best is None:
                return False, None
            i = best[1]
            last = (symbols[i], symbols[i + 1])
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        return True, last

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens stay apart when their joined characters are merged."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        # Undo the merges of both sides from the last to the first. At each point of time the symbols next to the seam are `left` and `right`;
        # a merge over the seam must not come before the next own merge of either side.
        rank, parts = self.rank, self.parts
        limit = (FAR, 0)     # time of the merge undone last: (rank, 0 left of the seam | 1 at the seam | 2 right of the seam)
        while True:
            over = rank.get(left + right)
            if over is not None and (over, 1) < limit:
                return False
            a = (rank[left], 0) if parts.get(left) else None
            b = (rank[right], 2) if parts.get(right) else None
            if a is None and b is None:
                return True
            if b is None or a is not None and a > b:
                limit, left = a, parts[left][1]
            else:
                limit, right = b, parts[right][0]

    def stretch(self, text: str) -> list[str]:
        """Tokens of one stretch; characters that are no piece are tokens of their own."""
        n = len(text)
        longest = [1] * n
        for end, size in self.machine.iter(text):
            longest[end + 1 - size] = size        # ends ascend: the longest match at a start comes last
        pairs, shorter, compatible = self.pairs, self.shorter, self.compatible
        failed = bytearray(n + 1)                 # the bitfield: ends of tokens from which no way leads on
        tokens: list[str] = []
        last, at, size = None, 0, longest[0]
        while at < n:
            while size:
                end = at + size
                token = text[at:end]
                if not failed[end]:
                    if last is None or (fits := pairs.get((last, token))) or fits is None and compatible(last, token):
                        break
                size = shorter.get(token, 0)
            if size:
                tokens.append(token)
                last, at = token, end
                size = longest[at] if at < n else 0
            else:
                failed[at] = 1                    # take the last token back and try a shorter one in its place
                token = tokens.pop()
                at -= len(token)
                last, size = tokens[-1] if tokens else None, shorter.get(token, 0)
        return tokens

    def _ids(self, text: str) -> str:
        """Decimal ids of a stretch, joined by commas; a leading `!` marks a stretch whose decoded text is not the stretch itself."""
        ids: list[int] = []
        for t in self.stretch(text):
            i = self.ids.get(t)
            if i is not None:
                ids.append(i)
            elif self.pieces.byte_ids:
                ids.extend(self.pieces.byte_ids[b] for b in t.encode())
            else:
                ids.append(self.pieces.unknown)
        joined = ",".join(map(str, ids))
        return joined if self.decode(ids, first=False) == text.replace(SPACE, " ") else "!" + joined

    #: A stretch ends before a word start, and at line ends (no piece).
    def split(self, text: str) -> list[str]:
        marked = (SPACE + text.replace(" ", SPACE)) if text else ""
        return self.pattern.findall(marked)

    def encode(self, text: str) -> tuple[str, int, str]:
        """Ids joined by commas, number of ids, and the text decoded from them."""
        stretches = self.split(text)
        joined = ",".join(map(self.memo.__getitem__, stretches))
        if "!" in joined:
            found = [self.memo[s] for s in stretches]
            decoded = "".join([self.decode(list(map(int, f[1:].split(","))), first=False) if f[:1] == "!" else s.replace(SPACE, " ") for f, s in zip(found, stretches)])
            joined = joined.replace("!", "")
        else:
            decoded = "".join(stretches).replace(SPACE, " ")
        return joined, joined.count(",") + 1 if joined else 0, decoded[1:] if decoded[:1] == " " else decoded

    def decode(self, ids: list[int], first: bool = True) -> str:
        """Text of ids; first: they begin a text, whose added space goes."""
        parts = [self.plain[i] for i in ids]
        if None in parts:
            out, run = [], bytearray()
            for i, part in zip([*ids, -1], [*parts, ""], strict=True):
                if part is None:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    out.append(decode_bytes(bytes(run)))
                    run.clear()
                out.append(part)
            parts = out
        text = "".join(parts)
        return text[1:] if first and ids and self.pieces.text[ids[0]].startswith(SPACE) else text


def decode_bytes(raw: bytes) -> str:
    """UTF-8 with one replacement character for each byte that is not part of a valid character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encoder(path: str) -> Encoder:
    """The encoder of this process for a model file, built once."""
    return held("sentencepiece", path, lambda: Encoder(load(path)))


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """`docs` with token_ids (array of int), n_tokens and decoded."""
    path = path or default_path(MODEL)

    def per_text(texts):
        e = encoder(path)
        ids, counts, decoded = [], [], []
        for t in texts:
            joined, n, text = e.encode(t.decode() if t else "")
            ids.append(list(map(int, joined.split(","))) if joined else [])
            counts.append(n)
            decoded.append(text)
        return ids, counts, decoded

    return add_columns(docs, text_col, "token_ids array<int>, n_tokens long, decoded string", per_text)


def digests(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """`docs` with n_tokens, ids_sha256 and decoded_sha256: what `encode` gives, as digests."""
    path = path or default_path(MODEL)

    def per_text(texts):
        e = encoder(path)
        counts, ids, decoded = [], [], []
        for t in texts:
            joined, n, text = e.encode(t.decode() if t else "")
            counts.append(n)
            ids.append(hashlib.sha256(joined.encode()).hexdigest())
            decoded.append(hashlib.sha256(text.encode()).hexdigest())
        return counts, ids, decoded

    return add_columns(docs, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", per_text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: number and digest of the ids of every document, and the digest of the text decoded from them."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the documents with their token ids."""
    return encode(docs).select("doc_id", "lang", "source", F.col("n_tokens"), "token_ids")
