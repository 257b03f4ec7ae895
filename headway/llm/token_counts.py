"""Token counts by a deterministic transducer compiled from a sentencepiece BPE vocabulary.

Which tokens a BPE encoder emits is a local matter: a sequence of tokens is
the encoder's own exactly if each two neighbours, encoded together, come out as
they are. So the last token of every prefix follows from the last tokens of
the few prefixes before it, and a finite state is enough: the tail of the text
that may still grow into a token, and for each cut in that tail the last token
there and the number of tokens. A transition reads one character and carries
the number of tokens it emits (negative when a longer token takes the place of
several). States are compiled when a text first reaches them.

No token holds a space behind another character, so the state after ``x`` and a
space does not depend on what came before. The state map of a chunk, cut
anywhere, is therefore: run the entering state over the chunk's head (up to the
first such point); from there count and exit state are constants. Maps compose
associatively, and a prefix scan over the chunks of a text gives its count.

Nulls and empty texts have no tokens. Special strings inside texts are plain
text, as in the library. Texts of any length are read whole; an empty table
gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = "▁"
CHUNK = 1 << 14
STATES = 400_000  # compiled states kept; then compilation begins anew
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*").findall


class Transducer:
    """States are numbers; ``steps[state][char]`` is (next state, tokens emitted)."""

    def __init__(self, data: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(data)
        kinds = proto.ModelProto.SentencePiece
        self.score = {p.piece: p.score for p in model.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.fallback = model.trainer_spec.byte_fallback or any(p.type == kinds.BYTE for p in model.pieces)
        self.longest = max(map(len, self.score))
        self.starts = {p[:k] for p in self.score for k in range(1, len(p) + 1)}
        self.fits: dict[tuple[str, str], bool] = {}
        self.compile_anew()

    def compile_anew(self) -> None:
        """The start state only: no tail, no token, nothing counted."""
        self.tails = [("", ((None, 0),))]
        self.number = {self.tails[0]: 0}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]
        self.runs: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        """The encoder itself, for the short texts that decide whether two tokens can be neighbours."""
        parts = list(text)
        while True:
            best = max(
                ((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score),
                default=None,
            )
            if best is None:
                return parts
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _fit(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) > common.CACHE_ENTRIES:
                self.fits.clear()
            found = self.fits[left, right] = self.pieces(left + right) == [left, right]
        return found

    def cost(self, piece: str) -> int:
        """Ids of one piece: a character outside the vocabulary becomes its bytes."""
        return 1 if piece in self.score or not self.fallback else len(piece.encode())

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        tail, cuts = self.tails[state]
        if char == SPACE and tail and tail[-1] != SPACE:
            tail, cuts = "", ((None, 0),)
        grown = tail + char
        last, total = None, 0
        for size in range(min(len(grown), self.longest), 0, -1):  # exactly one token ends here
            token = grown[-size:]
            if size > 1 and token not in self.score:
                continue
            before, count = cuts[len(cuts) - size]
            if self._fit(before, token):
                last, total = token, count + self.cost(token)
                break
        # Counts are relative to the state's own position, so that equal situations are one state.
        cuts = (*((t, n - total) for t, n in cuts), (last, 0))
        # A cut matters while a token may begin there.
        alive = [grown[k:] in self.starts for k in range(len(grown))]
        keep = alive.index(True) if True in alive else len(grown)
        cuts = (*(c if a else (None, 0) for c, a in zip(cuts, alive)), cuts[-1])
        key = (grown[keep:], cuts[keep:])
        target = self.number.get(key)
        if target is None:
            target = self.number[key] = len(self.tails)
            self.tails.append(key)
            self.steps.append({})
        step = self.steps[state][char] = (target, total)
        return step

    def run(self, state: int, text: str) -> tuple[int, int]:
        """Exit state and tokens emitted."""
        emitted, steps = 0, self.steps
        for char in text:
            step = steps[state].get(char) or self._compile(state, char)
            state, n = step
            emitted += n
        return state, emitted

    def count(self, run: str) -> int:
        """Tokens of a run of spaces and what follows up to the next space: from the start state."""
        found = self.runs.get(run)
        if found is None:
            if len(self.runs) > common.CACHE_ENTRIES:
                self.runs.clear()
            found = self.runs[run] = self.run(0, run)[1]
        return found


@lru_cache(1)
def transducer(data: bytes) -> Transducer:
    """One for each Python worker: states compiled by one task serve the next."""
    return Transducer(data)


@dataclass
class StateMap:
    """What a chunk does to a state: read ``head``; if ``reset``, ``count`` more tokens and ``state``."""

    head: str
    reset: bool = False
    count: int = 0
    state: int = 0

    def then(self, machine: Transducer, other: StateMap) -> StateMap:
        if not self.reset:
            return StateMap(self.head + other.head, other.reset, other.count, other.state)
        state, n = machine.run(self.state, other.head)
        if other.reset:
            return StateMap(self.head, True, self.count + n + other.count, other.state)
        return StateMap(self.head, True, self.count + n, state)


def state_map(machine: Transducer, chunk: str, first: bool) -> StateMap:
    """The map of one chunk; the first chunk of a text is entered in the start state, a reset at once."""
    cut = 0
    if not first:
        while 0 <= cut < len(chunk) and (chunk[cut] != SPACE or cut == 0 or chunk[cut - 1] == SPACE):
            cut = chunk.find(SPACE, cut + 1)
            if cut < 0:
                return StateMap(chunk)
    runs = _RUNS(chunk, cut)
    if not runs:
        return StateMap(chunk, *((True,) if first else ()))
    last = runs.pop()
    count = sum(map(machine.count, runs))
    state, n = machine.run(0, last)
    return StateMap(chunk[:cut], True, count + n, state)


def count_tokens(machine: Transducer, text: str) -> int:
    """Tokens of a whole text."""
    if not text:
        return 0
    if len(machine.tails) > STATES:
        machine.compile_anew()
    text = SPACE + text.replace(" ", SPACE)
    maps = (state_map(machine, text[at : at + CHUNK], at == 0) for at in range(0, len(text), CHUNK))
    *_, whole = accumulate(maps, lambda a, b: a.then(machine, b))
    return whole.count


def count(
    docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    common.ready(docs.sparkSession)
    data = common.vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(data.value)
        for batch in batches:
            n = [count_tokens(machine, t) for t in batch["text"].to_pylist()]
            columns = [batch["doc_id"], batch["n_bytes"], pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    rows = common.texts(docs, key, text).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
