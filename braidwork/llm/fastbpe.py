"""Whole-text ids from a tokenizers file, at the cost of the distinct words.

Both kinds of vocabulary used here start a new token before any space between two
ordinary characters, so a batch of texts is cut there, Arrow finds the distinct
chunks, the library's model encodes each of them once, and one Arrow ``take`` puts
the texts together from the chunks' ids.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters next to which a single space always is a token boundary: printable
#: ASCII and Latin, Greek and Cyrillic letters (no spaces, no combining marks).
_PLAIN = "!-~¡-˿Ͱ-҂"
_CUT = re.compile(f"(?<=[{_PLAIN}]) (?=[{_PLAIN}])")
_OTHER = re.compile(f"[^\n {_PLAIN}]")
#: Places where a run of Latin letters ends before punctuation (no apostrophe) or a
#: line's end, or begins after a line's end that follows punctuation: both are token
#: boundaries too.  Marked places are cut, and what follows has no space before it.
_LETTER, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "!-&(-/:-@\\[-`{-~"
_EDGE = re.compile(f"(?<=[{_LETTER}])(?=[{_MARKS}])|(?<=[{_MARKS}]\n)(?=[{_LETTER}])")
MARK = "\x01"
#: A comma or full stop that doesn't follow a letter or digit, or an empty line.
_RARE = re.compile(f"[^{_LETTER}0-9][.,][ \n]|\n\n")
#: A run of letters, one of punctuation and a line's end, each or none: pre-tokens of
#: both vocabularies, so the library's model takes them as they are.
_RUNS = re.compile(f"([{_LETTER}]*)([{_MARKS}]*)(\n?)")
#: Texts of these characters lower-case one character at a time.
_UNSAFE_LOWER = re.compile("[^\x00-įı-ɏ]")
#: Longer chunks are encoded each time they occur; up to twice MOST others are remembered.
LONGEST, MOST = 64, 150_000
#: Characters cut and put together at a time (a long text is never cut).
SLICE = 4_000_000


class Encoder:
    """``raw(text)`` holds the library's ``encode(text, add_special_tokens=False).ids``.

    The strings of special tokens in a text are those tokens, as the library has it;
    with ``special_as_text`` they are ordinary text.  ``lower``: the vocabulary
    lower-cases and drops spaces (else a space belongs to the word that follows)."""

    def __init__(self, path: str, lower: bool, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model = self.tokenizer.model
        added = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.lower, self.lead = lower, "" if lower else "Ġ"
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.spelt = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})
        self.packed = [struct.pack("<I", k) for k in range(self.tokenizer.get_vocab_size())]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}  # a chunk's ids, little-endian and 4 bytes each
        self.older: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def tokens(self, run: str) -> bytes:
        """The ids of a pre-token."""
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(run)])

    def chunk(self, text: str) -> bytes:
        """The ids of a chunk behind a space, or of one that begins with MARK."""
        lead, space = self.lead, " "
        if text[:1] == MARK:
            lead, space, text = "", "", text[1:]
        if not text:  # before a mark at a text's start, behind one at its end
            return b""
        runs = _RUNS.fullmatch(text)
        if not runs or text[:1] == "\n":
            return self.direct(space + text)
        word, marks, end = runs.groups()
        out = b""
        if word:
            if self.lower:
                word = word.lower()
            out, lead = self.tokens(lead + (word if word.isascii() else word.translate(self.spelt))), ""
        if marks:
            out += self.tokens(lead + marks)
        return out + self.tokens("Ċ") if end and not self.lower else out

    def chunks(self, distinct: list[str]) -> list[bytes]:
        """The ids of distinct chunks, from memory where they were met before."""
        if len(self.known) > MOST:
            self.known, self.older = {}, self.known
        known, older, out = self.known, self.older, []
        for c in distinct:
            got = known.get(c)
            if got is None:
                got = older.get(c) or self.chunk(c)
                if len(c) <= LONGEST and len(known) <= MOST:
                    known[c] = got
            out.append(got)
        return out

    def raw(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.batch([text])[0]

    def each(self, texts: list[str | None]):
        """``raw`` of one text after another, SLICE characters at a time."""
        lo = size = 0
        for hi, text in enumerate(texts, 1):
            size += len(text or "")
            if size >= SLICE or hi == len(texts):
                yield from self.batch(texts[lo:hi])
                pa.default_memory_pool().release_unused()  # a worker lives on beside others
                lo, size = hi, 0

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """``raw`` of every text; null is empty."""
        out: list[bytes] = [b""] * len(texts)
        plain: dict[int, str] = {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.special and "<" in text and self.special.search(text):
                out[i] = self.mixed(text)
                continue
            if self.lower and not _UNSAFE_LOWER.search(text):
                text = text.lower()
            if all_plain(text):
                plain[i] = marked(text)
            else:
                first, *rest = _CUT.split(text)
                out[i] = b"".join([self.direct(first), *self.chunks(rest)])
        if plain:
            self.joined(plain, out)
        return out

    def mixed(self, text: str) -> bytes:
        """A text cut at special tokens' strings, which become their ids."""
        out, last = [], 0
        for m in self.special.finditer(text):
            out += [self.raw(text[last : m.start()]), self.packed[self.tokenizer.token_to_id(m[0])]]
            last = m.end()
        return b"".join([*out, self.raw(text[last:])])

    def joined(self, plain: dict[int, str], out: list[bytes]) -> None:
        """Put the ids of marked texts into ``out`` at their places."""
        lists = pc.split_pattern(pa.array(plain.values(), pa.large_string()), " ")
        found = lists.values.dictionary_encode()
        ids = pa.array(self.chunks(found.dictionary.to_pylist()), pa.large_binary()).take(found.indices)
        edges, data = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1), memoryview(ids.buffers()[2])
        begin = lists.offsets.to_numpy()
        rest, end = edges[begin[:-1] + 1].tolist(), edges[begin[1:]].tolist()
        for (i, text), lo, hi in zip(plain.items(), rest, end):
            # The first chunk has no space before it.
            out[i] = self.direct(text.partition(" ")[0]) + data[lo:hi]


def marked(text: str) -> str:
    """A plain text with MARK behind a space at boundaries without one: at all of
    ``_EDGE``, or, faster, at the commas and full stops of ordinary prose."""
    if _RARE.search(text):
        return _EDGE.sub(" " + MARK, text)
    return text.replace(", ", f" {MARK}, ").replace(". ", f" {MARK}. ").replace(".\n", f" {MARK}.\n {MARK}")


def all_plain(text: str) -> bool:
    """Whether every space stands between two ordinary characters."""
    return not (_OTHER.search(text) or "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ")


_ENCODERS: dict[tuple[str, bool, bool], Encoder] = {}


def vocabulary_of(path: str) -> int:
    """The number of ids, special tokens included."""
    return encoder(path, False).tokenizer.get_vocab_size()


def encoder(path: str, lower: bool, special_as_text: bool = False) -> Encoder:
    """This worker's encoder: Spark reuses workers, so words stay known between tasks."""
    key = (path, lower, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
