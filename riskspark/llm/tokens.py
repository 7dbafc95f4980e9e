"""Exact, fast use of a byte-level BPE tokenizer on whole texts.

Byte-level BPE cuts a text into pieces by a pattern before it merges bytes. A
single space or line feed between two non-space characters always starts a
piece, and so do marks after a letter. So a text may be cut there, each distinct
part encoded once, and the ids joined: the result is that of encoding the whole
text. Texts with other white space are cut at fewer places, and texts that hold
an added token, such as an end mark, nowhere.
"""

from __future__ import annotations

import os
import re
import string
from array import array

#: Parts in each of the two generations of the cache, about 150 bytes each.
CACHE_PARTS = 500_000
#: Marks that make one piece after a letter; an apostrophe may belong to an ending.
MARKS = string.punctuation.replace("'", "")
#: Before a part: it stands after a line feed, or starts its text. Else a space stands before it.
AFTER_LINE, AT_START = "\n", "\r"

_CUT = re.compile(r"(?<=\S) (?=\S)")
_ENCODERS: dict[str, "Encoder"] = {}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Parts(dict):
    """Ids of parts; unknown ones are encoded when asked for, older ones kept a generation long."""

    def __init__(self, encoder: "Encoder"):
        self.encoder = encoder
        self.most = CACHE_PARTS
        self.old: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = self.encoder.part(part)
        self[part] = ids
        return ids

    def age(self) -> None:
        """Start a new generation if this one is full."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that are one id wherever a text holds them; such texts are encoded whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = self.tokenizer.model.tokenize
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        #: Letters of Latin-1 as the model's vocabulary writes their bytes.
        self.spelt = {i: bytewise.pre_tokenize_str(chr(i))[0][0] for i in range(256) if chr(i).isalpha()}
        self.space = bytewise.pre_tokenize_str(" ")[0][0]
        self.line = self.whole("\n")
        self.marks: dict[str, bytes] = {}
        #: Whether this tokenizer cuts as described; if not, texts are encoded whole.
        self.cuts = self.whole("Ab cd, ef\ngh.") == b"".join(map(self.whole, ("Ab", " cd", ",", " ef", "\n", "gh", ".")))
        self.parts = Parts(self)

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def part(self, part: str) -> bytes:
        """Ids of one part by its key."""
        stem = part.rstrip(MARKS)
        if len(stem) < len(part) and stem[-1:].isalpha():
            tail = part[len(stem) :]
            if tail not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[tail] = self.whole(tail)
            return self.parts[stem] + self.marks[tail]
        first = part[:1]
        bare, lead, before = (part[1:], "", self.line) if first == AFTER_LINE else (part[1:], "", b"") if first == AT_START else (part, self.space, b"")
        # A word of letters is one piece, so the model's merges alone give its ids.
        if bare.isalpha():
            if bare.isascii():
                return before + _packed([t.id for t in self.merge(lead + bare)])
            if max(bare) <= "\xff":
                return before + _packed([t.id for t in self.merge(lead + bare.translate(self.spelt))])
        return before + self.whole(bare if before or first == AT_START else f" {part}")

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, out = self.parts.__getitem__, []
        for text in texts:
            if any(map(text.__contains__, self.added)):
                out.append(self.whole(text))
                continue
            flat = text.replace("\n", " ")
            if self.cuts and flat and "  " not in flat and flat[0] != " " and flat[-1] != " " and flat.isprintable():
                out.append(b"".join(map(ids, (AT_START + text.replace("\n", " \n")).split(" "))))
                self.parts.age()
            elif text:
                pieces = _CUT.split(text) if self.cuts else [text]
                out.append(b"".join(map(self.whole, [pieces[0], *(f" {x}" for x in pieces[1:])])))
            else:
                out.append(b"")
        return out


def encoder(path: str, cache_parts: int = CACHE_PARTS) -> Encoder:
    """The encoder of this Python process for ``path``; it outlives a task, with a cache of ``cache_parts`` twice."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].parts.most = cache_parts
    return _ENCODERS[path]


def release_encoders() -> None:
    """Forget the encoders of this Python process."""
    _ENCODERS.clear()


def blocks(texts: list[str], chars: int = 4_000_000):
    """(start, end) of runs of texts of about ``chars`` characters; one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0
