"""BPE encoding by backtracking over longest matches, and decoding through an offset table."""

import functools
from struct import pack

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tallyloom.llm.rows import Memo, with_columns
from tallyloom.llm.word_bpe import Vocabulary, compiled, normalise, segments, word_symbols, words

#: Marks that only ever make a word of their own after letters.
_MARKS = ".,;:!?#$%&*|"


class Encoder:
    """Exact merges in linear time.

    An Aho-Corasick pass gives the longest token at every place of a word. Tokens are then
    laid from the left, each the longest that fits beside the one before (the pair table says
    so); where none fits, its place is marked as dead and the token before is shortened.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.lengths = [len(s) for s in vocabulary.symbols]
        self.matches = ahocorasick.Automaton()
        for symbols, token in vocabulary.by_symbols.items():
            self.matches.add_word(symbols, token)
        self.matches.make_automaton()
        self.shorter = [self._shorter(token) for token in range(vocabulary.size)]
        #: Ids of segments and of words.
        self.memo, self.known = Memo(), Memo()

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        symbols = self.v.symbols[token]
        for n in range(len(symbols) - 1, 0, -1):
            found = self.v.by_symbols.get(symbols[:n])
            if found is not None:
                return found
        return -1

    def word(self, symbols: str) -> list[int]:
        lengths, shorter, fits, pairs = self.lengths, self.shorter, self.v.fits, self.v.pairs
        n = len(symbols)
        longest = [-1] * (n + 1)
        for end, token in self.matches.iter(symbols):  # of one start, later ends are longer
            longest[end - lengths[token] + 1] = token
        if longest[0] >= 0 and lengths[longest[0]] == n:
            return [longest[0]]
        laid: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + lengths[token]
                if not dead[end]:
                    if not laid:
                        break
                    pair = laid[-1], token
                    if pairs[pair] if pair in pairs else fits(*pair):
                        break
                token = shorter[token]
            if token >= 0:
                laid.append(token)
                at = end
                token = longest[at]
            else:
                dead[at] = 1
                token = laid.pop()
                at -= lengths[token]
        return laid

    def remembered(self, word: str) -> bytes:
        found = self.known.get(word)
        if found is None:
            ids = self.word(word_symbols(word))
            found = self.known.keep(word, pack(f"<{len(ids)}I", *ids))
        return found

    def segment(self, segment: str) -> bytes:
        """Ids of a stretch without white space, as little-endian unsigned 32-bit integers."""
        stem = segment.rstrip(_MARKS)
        if stem.isalpha() and segment.isascii():
            found = self.remembered(stem)
            if len(stem) < len(segment):
                found += self.remembered(segment[len(stem) :])
        else:
            found = b"".join(map(self.remembered, words(segment)))
        return self.memo.keep(segment, found)

    def encode(self, text: str | None) -> bytes:
        found: list[bytes] = []
        memo, segment = self.memo, self.segment
        for i, stretch in enumerate(self.v.stretches(text or "")):
            if i % 2:
                found.append(np.array([self.v.special[stretch]], "<u4").tobytes())
            else:
                found += [memo.get(s) or segment(s) for s in segments(normalise(stretch))]
        return b"".join(found)


class Decoder:
    """Token texts in one block of bytes; token i is ``block[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, vocabulary: Vocabulary):
        texts = [f"{name} ".encode() for name in vocabulary.names]
        self.block = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.cumsum([0, *map(len, texts)])
        self.sizes = np.diff(self.offsets)

    def decode(self, ids: bytes | None) -> str:
        """Token texts with a blank between each two; an id outside the vocabulary is an error."""
        tokens = np.frombuffer(ids or b"", "<u4")
        if not len(tokens):
            return ""
        starts, sizes = self.offsets[tokens], self.sizes[tokens]
        ends = np.cumsum(sizes)
        places = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])
        return self.block[places[:-1]].tobytes().decode()


@functools.lru_cache(2)
def _encoder(raw: str) -> Encoder:
    return Encoder(compiled(raw))


@functools.lru_cache(2)
def _decoder(raw: str) -> Decoder:
    return Decoder(compiled(raw))


def _read(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", keep=None) -> DataFrame:
    """``df`` with the token ids of each text, as binary little-endian unsigned 32-bit integers.

    Row by row: a null text counts as empty and gives an empty value, repeated rows stay, an
    empty table gives an empty one. Special tokens' strings in a text give their ids. Texts
    are encoded whole, whatever their length. ``path`` names the vocabulary file on the driver.
    """
    raw = _read(df, path)

    def make():
        encoder = _encoder(raw.value)
        return lambda texts: ((encoder.encode(t),) for t in texts)

    return with_columns(df, text, StructType([StructField(ids, BinaryType())]), make, keep)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded", keep=None) -> DataFrame:
    """``df`` with the text of binary token ids; null or no ids give an empty text."""
    raw = _read(df, path)

    def make():
        decoder = _decoder(raw.value)
        return lambda rows: ((decoder.decode(r),) for r in rows)

    return with_columns(df, ids, StructType([StructField(text, StringType())]), make, keep)
