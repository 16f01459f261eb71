"""SentencePiece ids by weighted finite-state transduction: normaliser, pieces and byte fallback."""

from __future__ import annotations

import struct
from operator import add

import numpy as np

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_NEVER = float("inf")
#: What reading a character that no piece has weighs in a model of scores.
_FALLBACK = 1e6
_LONGEST_KEPT = 64
_MOST_KEPT = 300_000


def _fields(data: bytes):
    """(field number, value) of a serialised message; numbers as int or 4 raw bytes, the rest as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces, scores, kinds and the normaliser's switches of a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            top = list(_fields(file.read()))
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        for number, message in top:
            if number == 1:
                own = dict(_fields(message))
                self.pieces.append(own[1].decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
        trainer = dict(_fields(b"".join(m for n, m in top if n == 2)))
        normaliser = dict(_fields(b"".join(m for n, m in top if n == 3)))
        self.bpe = trainer.get(3, 1) == 2
        self.byte_fallback = bool(trainer.get(35, 0))
        self.charsmap = normaliser.get(2, b"")
        self.prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))


class Transducer:
    """Text to ids and back.

    Three transducers are composed with each input.  The normaliser writes the space
    mark for each blank and one before the text.  The piece transducer reads characters
    and writes ids; for a model of merges its states are pieces, and an arc from one
    piece to the next has weight 0 if merging their characters gives just these two, else
    infinity: a path of finite weight is then what merging the text gives, and the only one
    to each position.  For a model of scores there is one state and an arc weighs minus the
    score.  The fallback reads a character that no piece has and writes its bytes.  The
    ids are those of the shortest path in the (min, +) semiring, found in one pass over
    the positions of a part; parts end before a space mark, as no piece goes on past one.
    """

    def __init__(self, path: str):
        self.model = model = Model(path)
        if model.charsmap or model.squeeze:
            raise ValueError("only models with the identity normaliser that keep all blanks")
        self.ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] in (NORMAL, USER)}
        self.byte_ids = {int(model.pieces[i][3:5], 16): i for i, k in enumerate(model.kinds) if k == BYTE}
        self.unknown = model.kinds.index(UNKNOWN)
        self.endings = {p[n:] for p in self.ids for n in range(len(p))}
        # no piece holds any other two characters side by side, so none lies across them
        self.joined = {p[n : n + 2] for p in self.ids for n in range(len(p) - 1)}
        if any(b[1] == SPACE != b[0] for b in self.joined):
            raise ValueError("a piece goes on past a space mark")
        self.fits: dict[tuple[str, str], bool] = {}
        self.costs = {p: -model.scores[i] for p, i in self.ids.items()}
        self.histories: dict[str, tuple] = {}
        self.sound: set[str] = set()  # pieces that come out of merging their own characters
        self.output = [self._output(i) for i in range(len(model.pieces))]
        # a full table becomes the older one; what is asked for again comes back from it
        self.parts: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.older_runs: dict[str, bytes] = {}
        self.older_fits: dict[tuple[str, str], bool] = {}

    def _history(self, piece: str) -> tuple[list[tuple[float, str, str]], bool]:
        """The merges of a piece's characters, best score first, the leftmost of equals.

        (minus the score, first symbol, last symbol) after each merge, and whether the
        piece itself comes out.
        """
        if (known := self.histories.get(piece)) is not None:
            return known
        symbols = list(piece)
        steps = [(float("-inf"), symbols[0], symbols[-1])]
        while True:
            costs = [self.costs.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
            best = min(costs, default=_NEVER)
            if best == _NEVER:
                break
            i = costs.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            steps.append((best, symbols[0], symbols[-1]))
        known = steps, len(symbols) == 1
        if piece in self.ids:
            self.histories[piece] = known
            if known[1]:
                self.sound.add(piece)
        return known

    def _fit(self, last: str, piece: str) -> bool:
        """Whether merging the two side by side leaves them apart: both histories run on, whichever is next."""
        left, right = self._history(last)[0], self._history(piece)[0]
        i = j = 0
        while True:
            mine = left[i + 1][0] if i + 1 < len(left) else _NEVER
            theirs = right[j + 1][0] if j + 1 < len(right) else _NEVER
            across = self.costs.get(left[i][2] + right[j][1], _NEVER)
            if across != _NEVER and across < mine and across <= theirs:
                return False
            if mine == theirs == _NEVER:
                return True
            if mine <= theirs:
                i += 1
            else:
                j += 1

    def _weight(self, last: str, piece: str) -> float:
        """Of the arc that reads ``piece`` after ``last``."""
        if not self.model.bpe:
            return -self.model.scores[self.ids[piece]] if piece in self.ids else _FALLBACK
        if not self._history(piece)[1]:
            return _NEVER
        if not last:
            return 0.0
        if (fits := self.fits.get((last, piece))) is None:
            if (fits := self.older_fits.get((last, piece))) is None:
                fits = self._fit(last, piece)
            if len(self.fits) >= _MOST_KEPT:
                self.older_fits, self.fits = self.fits, {}
            self.fits[last, piece] = fits
        return 0.0 if fits else _NEVER

    def path(self, part: str) -> list[str]:
        """The pieces on the shortest path through one part."""
        end, ids, endings, weigh = len(part), self.ids, self.endings, self._weight
        merges, fits, sound = self.model.bpe, self.fits, self.sound
        # for each position the least weight of a path to it and the piece it ends with
        weights, lasts = [0.0] + [_NEVER] * end, [""] * (end + 1)
        for j in range(1, end + 1):
            starts = []
            for i in range(j - 1, -1, -1):
                piece = part[i:j]
                if piece in ids or i == j - 1:
                    starts.append((i, piece))
                if piece not in endings:
                    break
            least, last = _NEVER, ""
            for i, piece in reversed(starts):
                if (so_far := weights[i]) == _NEVER:
                    continue
                # arcs that were weighed before
                if merges and (piece in sound) and (not i or fits.get((lasts[i], piece))):
                    total = so_far
                else:
                    total = so_far + weigh(lasts[i], piece)
                if total < least:
                    least, last = total, piece
                    if not least:
                        break  # no path weighs less
            weights[j], lasts[j] = least, last
        pieces, at = [], end
        while at:
            pieces.append(lasts[at])
            at -= len(lasts[at])
        return pieces[::-1]

    def _numbers(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for piece in pieces:
            if (i := self.ids.get(piece)) is not None:
                out.append(i)
            elif self.model.byte_fallback:
                out += [self.byte_ids[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return np.array(out, dtype="<i4").tobytes()

    def _run(self, run: str) -> bytes:
        if (ids := self.runs.get(run)) is None:
            if (ids := self.older_runs.get(run)) is None:
                ids = self._numbers(self.path(run))
            if len(run) <= _LONGEST_KEPT:
                if len(self.runs) >= _MOST_KEPT:
                    self.older_runs, self.runs = self.runs, {}
                self.runs[run] = ids
        return ids

    def _part(self, part: str) -> bytes:
        """A part's ids: those of its runs between characters that no piece joins."""
        if (ids := self.older_parts.get(part)) is None:
            joined = self.joined
            cuts = [0, *[i for i, pair in enumerate(map(add, part, part[1:]), 1) if pair not in joined], len(part)]
            if len(cuts) == 2:
                ids = self._numbers(self.path(part))
            else:
                ids = b"".join([self._run(part[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
        if len(part) <= _LONGEST_KEPT:
            if len(self.parts) >= _MOST_KEPT:
                self.older_parts, self.parts = self.parts, {}
            self.parts[part] = ids
        return ids

    def normalised(self, text: str) -> str:
        return (SPACE if self.model.prefix else "") + text.replace(" ", SPACE) if text else ""

    def encode(self, text: str) -> bytes:
        """Ids as little-endian int32."""
        out, pending = [], ""
        for word in self.normalised(text).split(SPACE):
            # a word and the space marks before it
            if word:
                part = pending + word
                out.append(self.parts.get(part) or self._part(part))
                pending = SPACE
            else:
                pending += SPACE
        if len(pending) > 1:
            out.append(self._part(pending[:-1]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids: bytes joined, invalid ones as U+FFFD, space marks as blanks, without the first."""
        numbers = np.frombuffer(ids, dtype="<i4").tolist()
        out = b"".join([self.output[i] for i in numbers])
        if numbers and self.model.prefix and self.model.pieces[numbers[0]].startswith(SPACE):
            out = out[1:]
        return out.decode("utf-8", "replace")

    def _output(self, number: int) -> bytes:
        kind, piece = self.model.kinds[number], self.model.pieces[number]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process and file."""
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = Transducer(path)
    return _TRANSDUCERS[path]
