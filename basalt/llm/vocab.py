"""Vocabulary files of public tokenizers; their folder is a parameter, and nothing is copied or trained."""

from __future__ import annotations

import os

PIECES = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k"


def path(name: str, folder: str | None = None) -> str:
    """A file of the folder, or without one of the installed package."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def read_pieces(file: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) of a SentencePiece model by id; kind is normal, byte or other."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=file)
    out = []
    for i in range(sp.get_piece_size()):
        odd = sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        out.append((sp.id_to_piece(i), sp.get_score(i), "byte" if sp.is_byte(i) else "other" if odd else "normal"))
    return out


class Memo(dict):
    """A bounded cache of f(key) in two generations: a full young one becomes the old one."""

    def __init__(self, f, size: int) -> None:
        super().__init__()
        self.f, self.size, self.old = f, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.f(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
