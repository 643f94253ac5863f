"""A word-level byte BPE vocabulary: how texts are cut into words and which merges hold.

The vocabulary file is read where the plan is built and broadcast as it is (its size does not
grow with the data); each Python worker compiles it once.
"""

import functools
import json
import re
import unicodedata

import regex
from tokenizers import Regex, normalizers, pre_tokenizers

#: Fixed values of this kind of vocabulary: what the file must declare.
WORD_END = "</w>"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: White space that parts words, as code points of the Unicode property.
WHITE = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Controls that str.split() takes for white space, but the vocabulary takes for symbols.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SEGMENT = re.compile(f"[^{WHITE}]+")


@functools.lru_cache(1)
def _unknown() -> str:
    return "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")


@functools.lru_cache(1)
def _later_capitals() -> tuple[frozenset[str], dict[int, str]]:
    """Characters that the vocabulary's library lowers, but the standard library doesn't know."""
    low = normalizers.Lowercase().normalize_str(_unknown())
    cased = {ord(c): d for c, d in zip(_unknown(), low, strict=True) if c != d}
    return frozenset(map(chr, cased)), cased


@functools.lru_cache(1)
def _patterns() -> tuple[regex.Pattern, frozenset[str], regex.Pattern]:
    """The words' pattern; characters that the vocabulary's library classes otherwise, being of
    another version of Unicode; the pattern for segments that have such."""
    kinds = {"L": r"\p{L}", "N": r"\p{N}"}
    odd: set[str] = set()
    for kind, base in list(kinds.items()):
        cut = pre_tokenizers.Split(Regex(base), "removed", invert=True)
        theirs = {c for found, _ in cut.pre_tokenize_str(_unknown()) for c in found}
        ours = set(regex.findall(base, _unknown()))
        odd |= theirs ^ ours
        without = f"--[{''.join(ours - theirs)}]" if ours - theirs else ""
        kinds[kind + "+"] = f"[[{base}{without}]{''.join(theirs - ours)}]"

    def pattern(letter: str, number: str) -> regex.Pattern:
        return regex.compile(f"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|[^\\s{letter}{number}]+")

    return pattern(kinds["L"], kinds["N"]), frozenset(odd), pattern(kinds["L+"], kinds["N+"])


#: Entries of the table of pairs of tokens that a Python worker keeps.
PAIRS = 150_000
#: Added to a byte's symbol at the end of a word.
END = 256


def printable_bytes() -> list[str]:
    """For each byte, the character that stands for it in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def normalise(text: str) -> str:
    """Canonical composition and lower case; letters lower one by one, whatever their context."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    capital, lower = _later_capitals()
    if not capital.isdisjoint(text):
        text = text.translate(lower)
    return (text.replace("Σ", "σ") if "Σ" in text else text).lower()


def segments(text: str) -> list[str]:
    """The stretches between white space."""
    return _SEGMENT.findall(text) if _SEPARATORS.search(text) else text.split()


def words(segment: str) -> list[str]:
    usual, odd, other = _patterns()
    return (usual if segment.isascii() or odd.isdisjoint(segment) else other).findall(segment)


class Vocabulary:
    """Tokens as strings over 512 symbols: a byte's code, plus ``END`` for a word's last byte."""

    def __init__(self, raw: str):
        data = json.loads(raw)
        model = data["model"]
        kinds = [n["type"] for n in (data["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or kinds != NORMALIZERS:
            raise ValueError("not a lower-casing byte BPE vocabulary with word ends")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.names = [""] * self.size
        for name, i in [*ids.items(), *self.special.items()]:
            self.names[i] = name
        #: symbols[i]: the symbols of token i; order[a, b]: the rank of the merge of a and b.
        self.symbols = [""] * self.size
        for byte, char in enumerate(printable_bytes()):
            self.symbols[ids[char]] = chr(byte)
            self.symbols[ids[char + WORD_END]] = chr(END + byte)
        self.order: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.symbols[whole] = self.symbols[a] + self.symbols[b]
            self.order[a, b] = rank
            self.parts[whole] = (a, b, rank)
        self.by_symbols = {s: i for i, s in enumerate(self.symbols) if s}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.right_edge = functools.lru_cache(None)(functools.partial(self._edge, side=1))
        self.left_edge = functools.lru_cache(None)(functools.partial(self._edge, side=0))
        found = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self._special = re.compile(f"({found})") if found else None

    def stretches(self, text: str) -> list[str]:
        """Texts between special tokens at even places, special tokens at odd ones."""
        return self._special.split(text) if self._special and "<|" in text else [text]

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one edge of ``token`` while it is merged, each with the rank
        of the merge that uses it up."""
        found, used = [(token, float("inf"))], token
        while used in self.parts:
            rank, used = self.parts[used][2], self.parts[used][side]
            found.append((used, rank))
        return found

    def fits(self, a: int, b: int) -> bool:
        """Whether a's text followed by b's is merged to just these two tokens.

        It isn't if, at some time, a token at a's right edge and one at b's left edge both
        stand and their merge comes before the merges that use them up; of equal merges the
        left one comes first. Pairs met before are looked up in a table.
        """
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = found = self._fits(a, b)
        return found

    def _fits(self, a: int, b: int) -> bool:
        for x, x_used in self.right_edge(a):
            for y, y_used in self.left_edge(b):
                rank = self.order.get((x, y))
                if rank is not None and rank < x_used and rank <= y_used:
                    return False
        return True


@functools.lru_cache(2)
def compiled(raw: str) -> Vocabulary:
    return Vocabulary(raw)


def word_symbols(word: str) -> str:
    found = word.encode("utf-8").decode("latin-1")
    return found[:-1] + chr(END + ord(found[-1]))
