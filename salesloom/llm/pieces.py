"""The piece table of a public SentencePiece vocabulary and the pre-token rule."""

from __future__ import annotations

import math
from dataclasses import dataclass

from salesloom.llm.common import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
# A pre-token is a word with the space before it, or one white-space character.
# Words are taken whole, however long; joined, pre-tokens are the text.
PRE_TOKEN = r"\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]"
REMEMBERED_LENGTH = 64  # longer pre-tokens are worked out where they stand, and not kept
MOST_PIECES = 200_000  # a table of more is refused, as it is sent to every task
# Weights are whole numbers: thousandths of a nat, times COUNT, plus one for each
# token, so that one comparison takes the likelier and then the shorter path.
COUNT = 1 << 32  # no text has as many tokens
BYTE_COST = 14_000


@dataclass(frozen=True)
class Pieces:
    table: dict[str, tuple[int, int]]  # piece, with spaces as such: id, weight
    byte_ids: tuple[int, ...]  # id of each of the 256 byte tokens
    byte_weight: int
    longest: int
    prefixes: dict[str, tuple[int, int]]  # every prefix of a piece; id -1 if it is none itself

    def weight_of_bytes(self, char: str) -> int:
        return len(char.encode("utf-8", "surrogatepass")) * self.byte_weight


def load(model: str = MODEL) -> Pieces:
    """Read a model file.

    The file ranks pieces but gives no probabilities; ranks become unigram
    costs by Zipf's law: ln(1 + rank).
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    table: dict[str, tuple[int, int]] = {}
    byte_ids = [-1] * 256
    rank = 0
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            rank += 1
            table.setdefault(sp.id_to_piece(i).replace("▁", " "),
                             (i, round(1000 * math.log(1 + rank)) * COUNT + 1))
    if min(byte_ids) < 0:
        raise ValueError("the vocabulary has no byte tokens to fall back on")
    if len(table) > MOST_PIECES:
        raise ValueError(f"{len(table)} pieces; at most {MOST_PIECES} are sent to tasks")
    prefixes = {piece[:n]: (-1, 0) for piece in table for n in range(1, len(piece))} | table
    return Pieces(table, tuple(byte_ids), BYTE_COST * COUNT + 1, max(map(len, table)), prefixes)
