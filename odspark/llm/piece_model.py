"""The pieces of a SentencePiece model file, as plain Python values."""

from __future__ import annotations

from dataclasses import dataclass

SPACE = "▁"


@dataclass
class Pieces:
    """Pieces that text can match (id by piece, rank by id: 0 is the best score), byte pieces and the unknown id."""
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    unknown: int
    text: list[str]          # piece of every id


_LOADED: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    if path not in _LOADED:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        text = [sp.id_to_piece(i) for i in every]
        plain = [i for i in every if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        by_byte = {int(text[i][3:5], 16): i for i in every if sp.is_byte(i)}
        _LOADED[path] = Pieces({text[i]: i for i in plain}, {text[i]: sp.get_score(i) for i in plain},
                               [by_byte[b] for b in range(256)] if len(by_byte) == 256 else [], sp.unk_id(), text)
    return _LOADED[path]


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
