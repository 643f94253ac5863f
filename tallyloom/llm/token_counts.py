"""Token counts from a compiled finite-state transducer.

The vocabulary's rules become a deterministic transducer over characters. A state knows the
word begun so far only as far as later merges can reach back: the longest tail that begins a
token, with the last token and the relative count at each place of that tail. Each transition
carries how many tokens the count changes by. States and transitions are compiled when first
met. A chunk of text is summed up as a map of states; maps compose associatively, so a long
text is a scan over its chunks, whatever places they are cut at.
"""

import functools
import gc
from collections.abc import Iterable
from typing import NamedTuple

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom.llm.rows import with_columns
from tallyloom.llm.word_bpe import END, WHITE, Vocabulary, compiled, normalise, segments, words

#: States that a Python worker keeps, the first that it meets. Others are compiled where they
#: are met and forgotten; after ``RENEWED`` of these it begins anew. A bound on memory,
#: not on texts.
STATES, RENEWED = 150_000, 2_000_000
#: Stretches whose counts a Python worker remembers, words as many, and their longest, in characters.
SEGMENTS, LONGEST = 300_000, 64
#: Symbols that end a stretch of letters as one word of its own.
_MARKS = ".,;:!?#$%&*|"
#: Characters of one chunk.
CHUNK = 1 << 16
#: What may follow an apostrophe that begins a word, as whole words.
_SHORT_FORMS = {"s", "t", "re", "ve", "m", "ll", "d"}

_WHITE = frozenset(WHITE)
_BREAK = regex.compile(f"[{WHITE}]")


class _State(dict):
    """Transitions by character, each (next state, change of the count)."""

    __slots__ = ("closing", "key", "machine")

    def __missing__(self, char: str):
        found = self.machine.transition(self, char)
        if len(self.machine.states) < STATES:
            self[char] = found
        else:
            self.machine.missed += 1
        return found


#: A tail of symbols, and for each of its suffixes that begins a token, longest first, and for
#: the empty one: its size, the last token before it (-1 at a word's start), and the count there
#: relative to the tail's end.
_EMPTY = ("", ((0, -1, 0),))


class _Closed(dict):
    """Counts of stretches without white space, from the start state and back to it.

    Stretches are cut into words, which recur more often than they do. Counts don't depend on
    states, so they outlive the machine's.
    """

    def __init__(self, machine: "Transducer"):
        self.machine, self.known = machine, {}

    def __missing__(self, segment: str) -> int:
        stem = segment.rstrip(_MARKS)
        if segment.isascii() and stem.isalpha():
            found = self.word(stem)
            if len(stem) < len(segment):
                found += self.word(segment[len(stem) :])
        else:
            found = sum(map(self.word, words(segment)))
        return _keep(self, segment, found)

    def word(self, word: str) -> int:
        found = self.known.get(word)
        return _keep(self.known, word, self.machine.run(word + " ")[1]) if found is None else found


def _keep(known: dict[str, int], text: str, found: int) -> int:
    if len(text) <= LONGEST:
        if len(known) >= SEGMENTS:
            known.clear()
        known[text] = found
    return found


class Transducer:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.heads = {s[:n] for s in vocabulary.by_symbols for n in range(1, len(s))}
        self.closed = _Closed(self)
        self.reset()

    def reset(self) -> None:
        """Forget the states, not what was counted with them."""
        self.states: dict[tuple, _State] = {}
        self.missed = 0
        self.start = self.state(("start",))

    def state(self, key: tuple) -> _State:
        found = self.states.get(key)
        if found is None:
            found = _State()
            found.key, found.machine, found.closing = key, self, None
            if len(self.states) < STATES:
                self.states[key] = found
        return found

    def step(self, tail: tuple, symbol: str) -> tuple[tuple, int]:
        """The tail after one more symbol, and the change of the count."""
        text, places = tail
        text += symbol
        token_of, heads, pairs, n = self.v.by_symbols.get, self.heads, self.v.pairs, len(text) - 1
        token, kept = None, []
        for size, before, at in places:
            suffix = text[n - size :]
            if token is None:
                found = token_of(suffix)
                if found is not None:
                    if before >= 0:
                        fit = pairs.get((before, found))
                        if self.v.fits(before, found) if fit is None else fit:
                            token, change = found, at + 1
                    else:
                        token, change = found, at + 1
            if suffix in heads:
                kept.append((size + 1, before, at))
        kept = [(size, last, at - change) for size, last, at in kept]
        kept.append((0, token, 0))
        return (text[n + 1 - kept[0][0] :], tuple(kept)), change

    def grow(self, tail: tuple, pending: str, char: str) -> tuple[tuple, str, int]:
        """A word with its last symbol pending takes one more character."""
        if char < "\x80":
            if not pending:
                return tail, char, 0
            tail, change = self.step(tail, pending)
            return tail, char, change
        symbols = pending + char.encode("utf-8").decode("latin-1")
        total = 0
        for symbol in symbols[:-1]:
            tail, change = self.step(tail, symbol)
            total += change
        return tail, symbols[-1], total

    def close(self, tail: tuple, pending: str) -> int:
        """The change of the count by the pending symbol as the word's last."""
        text, places = tail
        text += chr(END + ord(pending))
        for size, before, at in places:
            token = self.v.by_symbols.get(text[-size - 1 :])
            if token is not None and (before < 0 or self.v.fits(before, token)):
                return at + 1
        raise ValueError("a symbol isn't in the vocabulary")

    def transition(self, of: _State, char: str) -> tuple[_State, int]:
        key = of.key
        kind = key[0]
        if kind == "quote":  # an apostrophe that begins a word, and what followed it
            after = key[1] + char
            if after in _SHORT_FORMS:
                return self.start, self.whole("'" + after)
            if any(form.startswith(after) for form in _SHORT_FORMS):
                return self.state(("quote", after)), 0
            state, total = self.begun("'")
            for c in after:
                state, change = state[c]
                total += change
            return state, total
        if kind == "start":
            if char in _WHITE:
                return self.start, 0
            return (self.state(("quote", "")), 0) if char == "'" else self.begun(char)
        _, run, tail, pending = key
        if run != "number" and _kind(char) == run:
            tail, pending, change = self.grow(tail, pending, char)
            return self.state(("word", run, tail, pending)), change
        if of.closing is None:
            of.closing = self.close(tail, pending)
        state, change = self.start[char]
        return state, change + of.closing

    def begun(self, char: str) -> tuple[_State, int]:
        tail, pending, change = self.grow(_EMPTY, "", char)
        return self.state(("word", _kind(char), tail, pending)), change

    def whole(self, word: str) -> int:
        tail, pending, total = _EMPTY, "", 0
        for char in word:
            tail, pending, change = self.grow(tail, pending, char)
            total += change
        return total + self.close(tail, pending)

    def run(self, text: str, state: _State | None = None) -> tuple[_State, int]:
        state, total = state or self.start, 0
        for char in text:
            state, change = state[char]
            total += change
        return state, total


@functools.lru_cache(1 << 14)
def _kind(char: str) -> str:
    if char in _WHITE:
        return "white"
    # The vocabulary's own word pattern tells what else is a letter, a number or a symbol.
    if len(words(char + "a")) == 1:
        return "letters"
    return "symbols" if len(words("%" + char)) == 1 else "number"


class ChunkMap(NamedTuple):
    """What a chunk does to any state: ``head`` runs on from it up to the first white space;
    behind that every state is the start state, so ``count`` tokens follow for certain and
    ``tail`` runs on into the next chunk. ``tail`` is None where the chunk has no white space."""

    head: str
    count: int
    tail: str | None


def chunk_map(machine: Transducer, chunk: str) -> ChunkMap:
    first = _BREAK.search(chunk)
    if not first:
        return ChunkMap(chunk, 0, None)
    last = max(map(chunk.rfind, _WHITE))
    return ChunkMap(chunk[: first.start()], _closed(machine, chunk[first.start() : last + 1]), chunk[last + 1 :])


def compose(machine: Transducer, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """The map of a's chunk followed by b's; associative."""
    if a.tail is None:
        return ChunkMap(a.head + b.head, b.count, b.tail)
    if b.tail is None:
        return ChunkMap(a.head, a.count, a.tail + b.head)
    return ChunkMap(a.head, a.count + _closed(machine, a.tail + b.head) + b.count, b.tail)


def _closed(machine: Transducer, text: str) -> int:
    """The count of a text between white space; stretches met before are looked up."""
    return sum(map(machine.closed.__getitem__, segments(text)))


def scan(machine: Transducer, maps: list[ChunkMap]) -> ChunkMap:
    """All maps composed pairwise, level by level, as a parallel scan does."""
    while len(maps) > 1:
        maps = [compose(machine, *maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


def count(machine: Transducer, text: str | None, chunk: int = CHUNK) -> int:
    total = 0
    for i, stretch in enumerate(machine.v.stretches(text or "")):
        if i % 2:
            total += 1
            continue
        stretch = normalise(stretch)
        if len(stretch) <= chunk:
            total += _closed(machine, stretch)
        else:
            maps = [chunk_map(machine, stretch[at : at + chunk]) for at in range(0, len(stretch), chunk)]
            whole = scan(machine, maps)
            total += whole.count + sum(_closed(machine, x) for x in (whole.head, whole.tail or ""))
    return total


@functools.lru_cache(1)
def _kept(raw: str) -> Transducer:
    return Transducer(compiled(raw))


def token_counts(
    df: DataFrame, path: str, text: str = "text", limit: int = 2048, keep: Iterable[str] | None = None
) -> DataFrame:
    """``df`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each text.

    Row by row and over whole texts: a null text counts as empty, repeated rows stay, an empty
    table gives an empty one, input columns named like results are replaced.
    """
    with open(path, encoding="utf-8") as file:
        raw = df.sparkSession.sparkContext.broadcast(file.read())

    def make():
        machine = _kept(raw.value)
        gc.disable()  # it would walk all states again and again; states are only dropped below

        def counts(texts):
            for t in texts:
                if machine.missed > RENEWED:
                    machine.reset()
                    gc.collect()
                yield len((t or "").encode("utf-8")), count(machine, t)

        return counts

    made = StructType([StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    got = with_columns(df, text, made, make, keep)
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
