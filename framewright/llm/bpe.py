"""Byte-level BPE by pre-tokens: the same ids as the tokenizers library, each pre-token encoded once.

A byte-level BPE file never merges across pre-tokens, so the ids of a text are those of its
pre-tokens in order.  Pre-tokens repeat a lot, so a table of them saves most of the encoding; a
missing one is merged by the file's own ranks.  Texts with characters whose class may differ between
Unicode versions, and tokenizers with other parts than a plain byte-level one, are given whole to the
library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import tiktoken
from tokenizers import Tokenizer

#: White space in the sense of Unicode.
SPACES = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def _settled() -> dict[str, str]:
    """Character classes: ``L`` letters, ``N`` numbers, ``O`` other characters than those and ``SPACES``.

    A character of the first plane is settled if Unicode 3.2 and the present version put it into one class, so
    that libraries with any version between them agree.  Blocks that only ever take symbols (currency signs,
    flags, pictographs) are settled as a whole."""
    space, runs = re.compile(f"[{SPACES}]"), {"L": [], "N": [], "O": [(0x20A0, 0x20CF), (0x1F1E6, 0x1F1FF), (0x1F300, 0x1FAFF)]}
    last = None
    for code in range(0x10000):
        old, new = (c[0] if c[0] in "LN" else "" if c in ("Cn", "Cs", "Co") else "O"
                    for c in (unicodedata.ucd_3_2_0.category(chr(code)), unicodedata.category(chr(code))))
        kind = old if old == new and not space.match(chr(code)) else ""
        if kind and kind == last:
            runs[kind][-1] = (runs[kind][-1][0], code)
        elif kind:
            runs[kind].append((code, code))
        last = kind
    return {k: "".join(f"\\U{a:08X}-\\U{z:08X}" for a, z in v) for k, v in runs.items()}


_CLASSES = _settled()
LETTERS, NUMBERS = _CLASSES["L"], _CLASSES["N"]

# The pre-token pattern of byte-level BPE files with use_regex, for settled characters.
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
           rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")

#: Characters outside the settled ones send a text to the library as a whole.
UNSETTLED = rf"[^{SPACES}{LETTERS}{NUMBERS}{_CLASSES['O']}]"

#: Longer texts are matched piecewise, so that their pre-tokens are never all in memory.
LONG = 1 << 22


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level files write for bytes: printable ones for themselves, the others
    from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked(spec: dict) -> tiktoken.Encoding | None:
    """The file's merges as ranks, if its ids follow the order of its merges."""
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in merges]
    if None in made or any(a >= b for a, b in zip(made, made[1:])):
        return None
    letters = _byte_letters()
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})


class PreTokens:
    """Splits texts into pre-tokens; special strings are split off first, as the library does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = all(not t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.plain = (plain and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                      and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                      and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.ranks = _ranked(spec) if self.plain else None
        self.pattern = re.compile(PATTERN)
        self.unsettled = re.compile(UNSETTLED)

    def whole_ids(self, text: str) -> list[int]:
        """Ids of a text by the library."""
        return self.library.encode(text, add_special_tokens=False).ids

    def token_ids(self, token: str) -> list[int]:
        """Ids of one pre-token or special string."""
        if token in self.special:
            return [self.special[token]]
        return self.ranks.encode_ordinary(token) if self.ranks else self.whole_ids(token)

    def runs(self, text: str) -> Iterable[list[str]] | None:
        """Lists of pre-tokens and special strings in order; None: encode the text whole."""
        if not self.plain or self.unsettled.search(text):
            return None
        if len(text) <= LONG and not (self.cut and self.cut.search(text)):
            return (self.pattern.findall(text),)
        return self._runs(text)

    def _runs(self, text: str) -> Iterator[list[str]]:
        parts = self.cut.split(text) if self.cut else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield [part]
            elif len(part) <= LONG:
                yield self.pattern.findall(part)
            else:
                found = (m.group() for m in self.pattern.finditer(part))
                while run := list(islice(found, 1 << 16)):
                    yield run


class Table(dict):
    """Pre-token -> value.  Starts from a given table; a miss is computed once and kept.  When it
    has grown to ``limit`` entries the kept misses are dropped and the given table stays."""

    def __init__(self, given: dict, value: Callable[[str], object], limit: int):
        super().__init__(given)
        self.given, self.value, self.limit = given, value, limit

    def __missing__(self, token: str):
        if len(self) >= self.limit + len(self.given):
            self.clear()
            self.update(self.given)
        v = self[token] = self.value(token)
        return v
