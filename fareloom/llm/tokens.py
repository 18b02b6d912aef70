"""Compiled form of a public tokenizer: a transducer over pre-tokens, exact to the library.

The pre-tokenizer is a regular language and white space always ends a pre-token, so tokenization is
a finite-state map: reading a whole pre-token leads from the start state back to it and emits the
pre-token's ids. Arcs are determinised lazily: the first time a pre-token is read, the library's
merges give its output, which then annotates the arc. The set of arcs is bounded; when it is full it
is dropped and built again, as lazy automata do. Text outside the alphabet the arcs are compiled for
(or that spells a special token) goes through the library, one stretch between blanks at a time.
"""

from __future__ import annotations

import json
import re
import sys
import types
from pathlib import Path

# The split pattern and normaliser the compiled form is for, as tokenizer files write them.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISERS = ["NFC", "Replace", "Lowercase"]

# The same pattern over lower-cased text up to U+017F, with the classes spelled out.
_LETTER = "a-zªµºß-öø-ÿĀ-ſ"
_DIGIT = "0-9²³¹¼-¾"
_BLANK = "\\x09-\\x0d \\xa0"
PRETOKEN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_BLANK}{_LETTER}{_DIGIT}]+"
)
# Characters the arcs are not compiled for: beyond U+017F, the dotted capital I, and controls whose
# class differs between libraries.
FOREIGN = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-įı-ſ]")
ASCII_BLANK = re.compile("[\\x09-\\x0d ]+")

MOST_ARCS = 400_000
LONGEST_ARC = 64  # longer pre-tokens are encoded each time


def read_tokenizer(path: str) -> bytes:
    """The tokenizer file, to be broadcast: a few MB whatever the corpus."""
    return Path(path).read_bytes()


def _memo(key: str, make):
    """One value per Python worker process, kept over its tasks (functions are shipped by value)."""
    holder = sys.modules.setdefault("_fareloom_llm_memo", types.ModuleType("_fareloom_llm_memo"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


class _Arcs(dict):
    """Pre-token -> its ids as little-endian 32-bit numbers."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        # The byte alphabet: printable bytes stand for themselves, the rest for 256 and up.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(own)]
        self.table = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def __missing__(self, pre: str) -> bytes:
        spelled = pre if pre.isascii() and pre.isalnum() else "".join(map(self.table.__getitem__, pre.encode()))
        out = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
        if len(pre) <= LONGEST_ARC:
            if len(self) >= MOST_ARCS:
                self.clear()
            self[pre] = out
        return out


class WordTransducer:
    """`ids(text)`: the library's ids as bytes, four for each."""

    def __init__(self, spec: dict, tok):
        self.tok = tok
        self.arcs = _Arcs(tok.model)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def _library(self, stretch: str) -> bytes:
        ids = self.tok.encode(stretch, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _plain(self, text: str) -> bool:
        return FOREIGN.search(text) is None and not any(s in text for s in self.special)

    def ids(self, text: str) -> bytes:
        if self._plain(text):
            return b"".join(map(self.arcs.__getitem__, PRETOKEN.findall(text.lower())))
        out = []
        for stretch in ASCII_BLANK.split(text):
            if self._plain(stretch):
                out += map(self.arcs.__getitem__, PRETOKEN.findall(stretch.lower()))
            else:
                out.append(self._library(stretch))
        return b"".join(out)

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4


class WholeText:
    """Tokenizers without blank-separated pre-tokens: the library reads the whole text."""

    def __init__(self, encode):
        self.encode = encode

    def ids(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.encode(text)])

    def count(self, text: str) -> int:
        return len(self.encode(text))


def _is_word_spec(spec: dict) -> bool:
    norm = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [n["type"] for n in norm] == NORMALISERS
        and [p["type"] for p in pre] == ["Split", "ByteLevel"]
        and pre[0]["pattern"].get("Regex") == WORD_SPLIT
        and pre[0]["invert"]
        and not pre[1]["add_prefix_space"]
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )


def compile_tokenizer(content: bytes):
    """The transducer for a tokenizer file (.json, or a sentencepiece .model)."""

    def make():
        if content[:1] != b"{":
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_proto=content)
            return WholeText(lambda text: sp.encode(text, num_threads=1))
        from tokenizers import Tokenizer

        text = content.decode()
        spec = json.loads(text)
        tok = Tokenizer.from_str(text)
        tok.no_truncation()
        tok.no_padding()
        if _is_word_spec(spec):
            return WordTransducer(spec, tok)
        return WholeText(lambda t: tok.encode(t, add_special_tokens=False).ids)

    return _memo(f"tokenizer-{hash(content)}", make)
