"""The lattice of a byte-pair vocabulary, read from left to right by a deterministic transducer.

For every prefix of a text, byte-pair merging has one last piece. It is the only piece that ends there and whose
predecessor, the last piece of the shorter prefix, stays beside it when the two are merged alone. So each position has
one back-pointer, and what the future needs of the past are the *alive* positions: those from which the text so far is
a proper prefix of some piece. That finite memory is a state; states and transitions are built when first met.

A transition carries the last piece and the change of the piece count. Where no piece can cover both neighbouring
characters, the state forgets what lies before.
"""

from __future__ import annotations

from typing import NamedTuple

SPACE = "▁"


class Pieces(NamedTuple):
    """What is used of a SentencePiece model file."""

    ids: dict[str, int]  # ordinary pieces
    scores: dict[str, float]
    byte_ids: list[int]
    names: list[str]
    dummy_prefix: bool


def load_pieces(path: str) -> Pieces:
    """Read a BPE model with byte fallback and the identity normaliser; other kinds are refused."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm, train = model.normalizer_spec, model.trainer_spec
    if train.model_type != 2 or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
        raise ValueError("only BPE models with byte fallback and without normalisation are supported")
    ids, scores, byte_ids = {}, {}, [0] * 256
    for i, p in enumerate(model.pieces):
        if p.type == 1:
            ids[p.piece], scores[p.piece] = i, p.score
        elif p.type == 6:
            byte_ids[int(p.piece[1:-1], 16)] = i
    return Pieces(ids, scores, byte_ids, [p.piece for p in model.pieces], norm.add_dummy_prefix)


class State(dict):
    """Maps the next character to (state, last piece, change of the count). ``key`` is what the state remembers, in one
    flat tuple: the characters back to the first alive position, then three values for each of those: the distance back
    to it, the last piece there, and its count relative to the current one."""

    __slots__ = ("key",)

    @property
    def depths(self) -> tuple[int, ...]:
        """The distances back to the alive positions, the current one (0) included."""
        return self.key[1::3]


_FRESH = ("", 0, "", 0)


class Lattice:
    """``limit`` bounds the states kept, ``joined_limit`` the pairs of pieces; when it is reached they are built anew as
    needed, with the same results."""

    def __init__(self, pieces: Pieces, limit: int = 150_000, joined_limit: int = 300_000) -> None:
        self.pieces, self.limit, self.joined_limit = pieces, limit, joined_limit
        self.scores = pieces.scores
        self.joined: dict[str, bool] = {}
        self.usable = {p: p for p in pieces.ids if len(p) == 1 or self.merge(p) == [p]}
        self.prefixes = {p[:i] for p in self.usable for i in range(1, len(p))}
        self.longest = max(map(len, self.usable), default=1)
        pairs = {p[i:i + 2] for p in self.usable for i in range(len(p) - 1)}
        self.pairs = pairs
        self.states: dict[tuple, State] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states. They lead to each other in circles, which are cut, so that their memory is free at once;
        one still in use lives on, and its successors are built anew."""
        for state in self.states.values():
            state.clear()
        self.states = {}
        self.start = self.state(_FRESH)

    def merge(self, text: str) -> list[str]:
        """Byte-pair merging as defined: the best-scored neighbouring pair first, the leftmost among equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        if not left or left[-1] + right[0] not in self.pairs:
            return True
        key = chr(len(left)) + left + right
        known = self.joined.get(key)
        if known is None:
            if len(self.joined) >= self.joined_limit:
                self.joined.clear()
            known = self.joined[key] = self.merge(left + right) == [left, right]
        return known

    def state(self, key: tuple) -> State:
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State()
            found.key = key
        return found

    def cost(self, piece: str) -> int:
        return 1 if piece in self.pieces.ids else len(piece.encode())

    def step(self, state: State, char: str) -> tuple[State, str, int]:
        """The transition for a character that ``state`` has not met yet."""
        if len(self.states) >= self.limit:
            self.reset()
        key = state.key
        if key[0] and key[0][-1] + char not in self.pairs:
            key = _FRESH  # nothing spans this boundary
        text = key[0] + char
        end = len(text) - 1
        alive = range(1, len(key), 3)
        for i in alive:  # the longest first
            piece = text[end - key[i]:]
            if (key[i] == 0 or piece in self.usable) and self.compatible(key[i + 1], piece):
                piece = self.usable.get(piece, piece)  # one string for all states
                change = key[i + 2] + self.cost(piece)
                break
        else:  # pragma: no cover - merging always has a last piece
            raise AssertionError(text)
        kept: list = [char]
        for i in alive:
            if text[end - key[i]:] in self.prefixes:
                kept += (key[i] + 1, key[i + 1], key[i + 2] - change)
        kept += (0, piece, 0)
        if kept[1]:
            kept[0] = text[end + 1 - kept[1]:]
        result = state[char] = (self.state(tuple(kept)), piece, change)
        return result

    def surface(self, text: str) -> str:
        """A text as the model reads it: spaces become marks, and one stands in front."""
        if not text:
            return ""
        return (SPACE if self.pieces.dummy_prefix else "") + text.replace(" ", SPACE)
