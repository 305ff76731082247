"""A unigram vocabulary of pieces, and the units that texts fall into."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import sentencepiece

#: The character that stands for a blank in pieces.
MARKER = "▁"
#: An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Units whose segmentation a worker remembers before it starts afresh.
MEMO_UNITS = 1 << 18


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id: text, log score, and whether texts may contain them."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    usable: tuple[bool, ...]
    byte_ids: tuple[int, ...]
    unknown_score: float
    key: str

    @property
    def cuts_at_blanks(self) -> bool:
        """No usable piece goes on with a marker after another character."""
        return not any(
            MARKER in p.lstrip(MARKER) for p, ok in zip(self.pieces, self.usable) if ok
        )


def load_vocabulary(path: str) -> Vocabulary:
    """Read a SentencePiece model; its pieces' scores are the unigram log scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    usable = [
        not (model.is_control(i) or model.is_byte(i) or model.is_unused(i) or model.is_unknown(i))
        for i in ids
    ]
    scores = [float(model.get_score(i)) for i in ids]
    worst = min((s for s, ok in zip(scores, usable) if ok), default=0.0)
    byte_ids = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
    return Vocabulary(
        tuple(model.id_to_piece(i) for i in ids),
        tuple(scores),
        tuple(usable),
        tuple(byte_ids[f"<0x{b:02X}>"] for b in range(256)),
        worst - UNKNOWN_PENALTY,
        path,
    )


def units(text: str, cuts_at_blanks: bool) -> list[str]:
    """The text as units that no piece crosses, each without its first marker.

    A blank is put before the text, then every blank that follows another
    character opens a unit. Where pieces may cross blanks, the text is one unit.
    """
    if not text:
        return []
    text = text.replace(MARKER, " ")
    if not cuts_at_blanks:
        return [text]
    parts = text.split(" ")
    if "" not in parts:
        return parts
    joined: list[str] = []
    blanks = 0
    for part in parts[:-1]:
        if part:
            joined.append(" " * blanks + part)
            blanks = 0
        else:
            blanks += 1
    joined.append(" " * blanks + parts[-1])
    return joined


class Memo(dict):
    """Results by unit, made on demand; those not asked for lately are forgotten."""

    def __init__(self, make: Callable, most: int = MEMO_UNITS):
        super().__init__()
        self.make, self.most = make, most
        self.older: dict = {}

    def __missing__(self, unit):
        found = self.older.get(unit)
        if found is None:
            found = self.make(unit)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[unit] = found
        return found
