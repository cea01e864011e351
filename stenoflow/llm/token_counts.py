"""Token counts of a byte-pair vocabulary by a compiled finite-state transducer.

The tokenisation of a text's prefix is determined by its last token, and a sequence of
tokens is the tokenisation of its text exactly if every neighbouring pair is the
tokenisation of its own text: merges at a boundary depend on the two tokens beside it
alone.  So reading one more character moves a deterministic machine whose state is the
chain of last tokens of the prefixes that a longer token may still reach back to, and
the transition emits the change of the token count (which is negative where a longer
token takes in shorter ones).  States and transitions are compiled on first use and
shared by all texts of a worker.

A text is cut into chunks.  A chunk's map of states takes a start state to the state in which
it ends and the tokens counted; it is made for the state that a short run-up to the chunk
gives, which is the true one as soon as the machine has forgotten where it began, and for
other states when they are met.  Neighbouring maps compose, in a scan of logarithmic depth.
No piece holds a blank after a character of another kind, so at such places the machine is
back in one of its start states, and the words between them are single transitions.

Defined cases: null and empty texts have no token.  Texts of any length are read whole.
Repeated rows get equal counts.  Columns named like the results are replaced by them;
other columns stay.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.llm import common as C

BLANK = "▁"
#: Characters per chunk of a text.
CHUNK = 1 << 14
#: Characters before a chunk from which its start state is guessed.
WARM_UP = 96
#: Compiled transitions kept by a worker; past this the machine is compiled afresh.
MAX_TRANSITIONS = 600_000
MAX_UNITS = 600_000
#: Texts of more tokens are marked.
LIMIT = 4096


class State(dict):
    """Transitions by character to (state, change of the count), with what the compiler needs."""

    __slots__ = ("chain", "tail")

    def __init__(self, tail: str, chain: tuple):
        super().__init__()
        #: The last characters, as many as some longer token may begin with.
        self.tail = tail
        #: Last tokens and counts (less the count here) of the prefixes that end before
        #: tail[i:], for every i, and here.
        self.chain = chain


class Units(dict):
    """Emitted counts of the units between resting places, less their first blank."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, unit: str) -> int:
        count = self[unit] = self.machine.run(BLANK + unit, self.machine.start)[1]
        return count


@dataclass
class Transducer:
    """Counts the tokens of a SentencePiece byte-pair model with byte fallback."""

    scores: dict[str, float]
    #: Tokens that a character outside the vocabulary takes.
    unknown_bytes: bool = True
    states: dict = field(default_factory=dict)
    pairs: dict = field(default_factory=dict)

    def __post_init__(self):
        self.prefixes = {p[:k] for p in self.scores for k in range(1, len(p))}
        self._reset()

    def _reset(self):
        self.states.clear()
        self.pairs.clear()
        self.made = 0
        self.start = self._state("", ((None, 0),))
        self.units = Units(self)

    # -- the pairwise rule ---------------------------------------------------------------
    def merge(self, text: str) -> list[str]:
        """Tokens of a short text by best-first merging, leftmost first among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: str, right: str) -> bool:
        """Whether `right` may stand after `left` in a tokenisation."""
        key = (left, right)
        got = self.pairs.get(key)
        if got is None:
            got = self.pairs[key] = self.merge(left + right) == [left, right]
        return got

    def token_ok(self, token: str) -> bool:
        got = self.pairs.get(token)
        if got is None:
            got = self.pairs[token] = self.merge(token) == [token]
        return got

    # -- compilation -----------------------------------------------------------------------
    def _state(self, tail: str, chain: tuple) -> State:
        key = (tail, chain)
        got = self.states.get(key)
        if got is None:
            got = self.states[key] = State(tail, chain)
        return got

    def compile(self, state: State, char: str) -> tuple[State, int]:
        self.made += 1
        if char == BLANK and state.tail and state.tail[-1] != BLANK:
            # no piece spans this place, so what was read before is settled
            nxt, delta = self.compile(self.start, char)
        elif char not in self.scores:
            size = len(char.encode("utf-8")) if self.unknown_bytes else 1
            # a character outside the vocabulary merges with nothing on either side
            nxt, delta = self.start, size
        else:
            text = state.tail + char
            for k in range(len(text)):
                token = text[k:]
                if (len(token) > 1 and token not in self.scores) or not self.token_ok(token):
                    continue
                before, count = state.chain[k]
                if before is None or self.follows(before, token):
                    break
            else:
                raise ValueError(f"no token ends at {text!r}")
            delta = count + 1
            keep = 0
            while keep < len(text) and text[keep:] not in self.prefixes:
                keep += 1
            chain = tuple((t, c - delta) for t, c in state.chain[keep:]) + ((token, 0),)
            nxt = self._state(text[keep:], chain) if keep < len(text) else self._state("", ((token, 0),))
        state[char] = nxt, delta
        return nxt, delta

    def run(self, text: str, state: State) -> tuple[State, int]:
        total = 0
        for char in text:
            step = state.get(char)
            if step is None:
                step = self.compile(state, char)
            state = step[0]
            total += step[1]
        return state, total

    def settled(self, text: str) -> int:
        """Tokens of a text that begins with a blank and ends before one or at the text's end.

        Between resting places the machine runs from a start state, so a whole unit is one
        transition, compiled on first use.
        """
        units = text[1:].split(BLANK)
        if "" in units:
            units = [u[1:] for u in _UNITS.findall(text)]
        return sum(map(self.units.__getitem__, units))

    # -- chunks ----------------------------------------------------------------------------
    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        self._tidy()
        text = BLANK + text.replace(" ", BLANK)
        if len(text) <= CHUNK:
            return self.settled(text)
        maps = []
        for at in range(0, len(text), CHUNK):
            self._tidy()
            likely = self.run(text[max(0, at - WARM_UP) : at], self.start)[0] if at else self.start
            maps.append(ChunkMap(self, text[at : at + CHUNK], (), likely))
        while len(maps) > 1:
            maps = [ChunkMap(self, "", tuple(maps[i : i + 2]), maps[i].likely) for i in range(0, len(maps), 2)]
        return maps[0](self.start)[1]

    def _tidy(self) -> None:
        """Compiles afresh when the machine has grown too large; states in use stay valid."""
        if self.made > MAX_TRANSITIONS or len(self.units) > MAX_UNITS:
            self._reset()


class ChunkMap:
    """What a stretch of text does to states: start state to (end state, count).

    The map is filled in for the likely start state when it is made: of a chunk, by running the
    machine, or of two neighbouring stretches, by composing their maps.  Start states that it
    lacks are added when they are met, in the same way, so a wrong guess costs time alone.
    """

    __slots__ = ("machine", "text", "parts", "likely", "known", "inner")

    def __init__(self, machine: Transducer, text: str, parts: tuple, likely: State):
        self.machine, self.text, self.parts, self.likely = machine, text, parts, likely
        self.known: dict[int, tuple] = {}
        #: Of a chunk with a resting place: where it is, the end state and the count from there.
        self.inner: tuple | None = None
        self(likely)

    def __call__(self, state: State) -> tuple[State, int]:
        got = self.known.get(id(state))
        if got is None:
            # the state is kept, so its id is not used again
            got = self.known[id(state)] = (*self._go(state), state)
        return got[:2]

    def _go(self, state: State) -> tuple[State, int]:
        if self.parts:
            total = 0
            for part in self.parts:
                state, count = part(state)
                total += count
            return state, total
        if self.inner is None:
            at = _rest(self.text)
            if at < 0:
                self.inner = at, None, 0
            else:
                last = _last_rest(self.text)
                end, count = self.machine.run(self.text[last:], self.machine.start)
                self.inner = at, end, count + (self.machine.settled(self.text[at:last]) if last > at else 0)
        at, end, count = self.inner
        if at < 0:
            return self.machine.run(self.text, state)
        return end, self.machine.run(self.text[:at], state)[1] + count


def _rest(text: str) -> int:
    """First place of text before a blank and after another character, -1 if there is none."""
    at = text.find(BLANK, 1)
    while at > 0 and text[at - 1] == BLANK:
        at = text.find(BLANK, at + 1)
    return at


def _last_rest(text: str) -> int:
    """Last such place of a text that has one."""
    at = text.rfind(BLANK)
    while at > 0 and text[at - 1] == BLANK:
        at -= 1
    if at > 0:
        return at
    raise ValueError("no resting place")


_UNITS = re.compile(f"{BLANK}+[^{BLANK}]*")

_loaded: dict[str, Transducer] = {}


def transducer(model_file: str) -> Transducer:
    """The worker's transducer of a SentencePiece BPE model: a file, or the name of a public vocabulary.

    A name is looked up where the worker runs.
    """
    if model_file not in _loaded:
        from sentencepiece import sentencepiece_model_pb2 as pb

        path = model_file
        if "/" not in model_file:
            import public_tokenizers

            path = public_tokenizers.path(model_file)
        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        spec = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("a BPE model without normalisation rules is needed")
        normal = {p.piece: p.score for p in m.pieces if p.type == 1}
        if any(BLANK in p.strip(BLANK) or (p.endswith(BLANK) and p.strip(BLANK)) for p in normal):
            raise ValueError("a piece holds a blank after another character")
        _loaded[model_file] = Transducer(normal, m.trainer_spec.byte_fallback)
    return _loaded[model_file]


_COUNTS = T.StructType().add("n_bytes", T.LongType()).add("n_tokens", T.LongType())


def count_tokens(
    df: DataFrame,
    model_file: str,
    *,
    text: str = "text",
    to: tuple[str, str, str] = ("n_bytes", "n_tokens", "over_limit"),
    limit: int = LIMIT,
) -> DataFrame:
    """df with UTF-8 size, number of tokens, and whether they are above the limit."""
    C.ship(df.sparkSession)
    n_bytes, n_tokens, over = to

    @F.arrow_udf(T.LongType())
    def tokens(column: pa.Array) -> pa.Array:
        machine = transducer(model_file)
        return pa.array([machine.count(t) if t else 0 for t in column.to_pylist()], pa.int64())

    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    n, name = C.free_name(df, "__n"), C.free_name(df, "__counts")
    counted = df.withColumn(n, tokens(t)).withColumn(
        name,
        F.struct(
            F.octet_length(t).cast("long").alias(n_bytes),
            F.col(n).alias(n_tokens),
            (F.col(n) > limit).alias(over),
        ),
    )
    return C.replace_columns(counted.drop(n), name, list(to))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 32k-piece byte-pair model."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, "piece_bpe_32k.model").drop("text")
