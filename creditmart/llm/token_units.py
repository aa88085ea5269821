"""Cutting texts into units that a tokenizer treats independently, and caches of what units give.

A unit is a run of ASCII white space with the non-white run after it. No pre-token of the two JSON
tokenizers reaches from a non-white character into following white space, so the tokens of a text
are those of its units. That fails only where white space outside ASCII borders on a unit's edge;
texts with such a character are encoded whole.

What a unit gives is asked of the ``tokenizers`` library, or, for units of ASCII and Latin letters,
of ``tiktoken`` with the same vocabulary, which merges several times faster. Merging by token rank
and by the merge list agree because the list is in the order of the token ids; ``tests/llm``
compares both on the words of the test tables.
"""

from __future__ import annotations

import gc
import os
import re
import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

UNIT = re.compile(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+")
SOLID = re.compile(r"[^ \t\n\x0b\x0c\r]+")
#: White space, by any reading, outside space and \t to \r; and a few invisible characters.
OTHER_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f\\u2060\\u3000\\ufeff]")
#: Letters whose class, case and normal form no Unicode version has changed.
PLAIN = re.compile("[\\t-\\r -~\\u00a1-\\u012f\\u0131-\\u017e]+")
#: The same white space between all words but these makes a text irregular.
IRREGULAR = ("\t", "\x0b", "\x0c", "\r", "\0", "  ", "\n\n", " \n", "\n ")
MAX_CACHED_UNIT = 64
#: The tokenizers' split patterns, for plain characters.
BYTE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|(?:(?![\\u00d7\\u00f7])[a-z\\u00aa\\u00b5\\u00ba\\u00c0-\\u017e])+|[0-9\\u00b2\\u00b3\\u00b9\\u00bc-\\u00be]|(?:(?![a-z0-9\\u00aa\\u00b2\\u00b3\\u00b5\\u00b9\\u00ba\\u00bc-\\u00be\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u017e])[^\\s])+")
WORD_END = b"\xff"  # a byte that UTF-8 never has stands for the end of a word


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _byte_of_letter() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file: itself, or the next free from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks(tokenizer) -> dict[bytes, int]:
    """The vocabulary as bytes, without added tokens."""
    letters, added, found = _byte_of_letter(), set(tokenizer.get_added_tokens_decoder()), {}
    for token, number in tokenizer.get_vocab().items():
        if number not in added:
            end = WORD_END if token.endswith("</w>") else b""
            found[bytes(letters[c] for c in token.removesuffix("</w>")) + end] = number
    return found


def has_other_space(text: str) -> bool:
    if text.isascii():
        return any(c in text for c in "\x1c\x1d\x1e\x1f")
    return OTHER_SPACE.search(text) is not None


def keyed_units(text: str) -> list[str] | None:
    """A key for each unit, or None for a text to be encoded whole.

    The key of a unit that starts with one space is the rest of it, that of one starting with a line
    break is itself; any other has a NUL before it.
    """
    if has_other_space(text):
        return None
    if any(c in text for c in IRREGULAR) or text[:1] in ("", " ", "\n") or text[-1:] in (" ", "\n"):
        return ["\0" + u for u in UNIT.findall(text)]
    return ("\0" + text).replace("\n", " \n").split(" ")


def unit_of(key: str) -> str:
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else " " + key


class UnitCache(dict):
    """key -> value; keys not yet there are encoded and kept.

    At half the capacity the cache becomes the old generation and a new one begins; what is asked again
    moves to the new one. Long keys are encoded anew each time, so ``capacity`` bounds the memory.
    """

    def __init__(self, encode: Callable, first: dict, capacity: int):
        super().__init__(first)
        self.encode, self.old, self.half = encode, {}, max(1, capacity // 2)

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.encode(key)
        if len(key) <= MAX_CACHED_UNIT:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


_kept: dict = {}
_users, _released = 0, 0.0
IDLE_SECONDS = 3.0


@contextmanager
def kept(make: Callable, *arguments):
    """make(*arguments), made once in a worker process and kept there for tasks that soon follow.

    What is kept goes when no task of the worker has used any of it for ``IDLE_SECONDS``: Spark's workers outlive a query, and their
    memory is then wanted for others.
    """
    global _users, _released
    key = (make.__name__, *arguments)
    if key not in _kept:
        _kept[key] = make(*arguments)
    _users += 1
    try:
        yield _kept[key]
    finally:
        _users -= 1
        if not _users:
            _released = time.monotonic()
            timer = threading.Timer(IDLE_SECONDS, _drop, (_released,))
            timer.daemon = True
            timer.start()


def _drop(released: float) -> None:
    if not _users and released == _released:  # nothing has been used since
        _kept.clear()
        gc.collect()  # encoders and their caches name each other


def byte_counter(tokenizer) -> Callable[[str], int]:
    """Tokens of a keyed unit, for a byte-level tokenizer with the split pattern above."""
    import tiktoken

    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    fast = tiktoken.Encoding("bytes", pat_str=BYTE_PATTERN, mergeable_ranks=ranks(tokenizer), special_tokens={})

    def count(key: str) -> int:
        unit = unit_of(key)
        if PLAIN.fullmatch(unit) and not any(a in unit for a in added):
            return len(fast.encode_ordinary(unit))
        return len(tokenizer.encode(unit, add_special_tokens=False))

    return count


def word_cache(tokenizer, capacity: int = 400_000) -> UnitCache:
    """Non-white unit -> its ids as little-endian 32-bit numbers, for the word tokenizer.

    Many units differ only in case or punctuation; their words have entries of their own, so that each is merged once.
    """
    from array import array
    from sys import byteorder

    import tiktoken

    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    fast = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks(tokenizer), special_tokens={})
    merge = fast._encode_single_piece

    def packed(numbers: list[int]) -> bytes:
        out = array("I", numbers)
        if byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def ids(unit: str) -> bytes:
        if unit.isascii() and unit.isalpha():
            low = unit.lower()
            return packed(merge(low.encode() + WORD_END)) if low == unit else cache[low]
        if PLAIN.fullmatch(unit) and not any(a in unit for a in added):
            words = WORD_PATTERN.findall(unit.lower())
            if words == [unit]:
                return packed(merge(unit.encode() + WORD_END))
            return b"".join(map(cache.__getitem__, words))
        return packed(tokenizer.encode(unit, add_special_tokens=False).ids)

    cache = UnitCache(ids, {}, capacity)
    return cache


def word_encoder(tokenizer, capacity: int = 400_000) -> Callable[[str], bytes]:
    """The same as a function."""
    return word_cache(tokenizer, capacity).__getitem__


def _latin_kinds() -> bytes:
    """For bytes.translate of Latin-1 texts: space, a (letter), 0 (digit), . (other) or X (not plain), as ``WORD_PATTERN`` sorts them."""
    kinds = bytearray(b"X" * 256)
    for code in range(256):
        character = chr(code)
        if character in " \t\n\x0b\x0c\r":
            kinds[code] = ord(" ")
        elif PLAIN.fullmatch(character):
            low = character.lower()
            kinds[code] = ord("a") if re.fullmatch("[a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017e]", low) else ord("0") if re.fullmatch("[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]", low) else ord(".")
    return bytes(kinds)


_KINDS = _latin_kinds()


def apart(text: str) -> str | None:
    """The text in lower case with its full stops and commas apart from words, or None where that may change its words.

    They are words of their own where no two such signs touch. Words then recur in one form: far fewer have to be merged.
    """
    try:
        kinds = text.encode("latin-1").translate(_KINDS)
    except UnicodeEncodeError:
        return None
    return None if b".." in kinds or b"X" in kinds else text.lower().replace(",", " , ").replace(".", " . ")


def document_encoder(path: str, capacity: int) -> Callable[[str], bytes]:
    """Ids of a whole text as little-endian 32-bit numbers, for the word tokenizer at a path; it has the size of the ``vocabulary``."""
    tokenizer = load(path)
    cache = word_cache(tokenizer, capacity)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encoded(text: str) -> bytes:
        if has_other_space(text):
            from array import array

            return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        simple = None if any(a in text for a in added) else apart(text)
        if simple is not None:
            return b"".join(map(cache.__getitem__, simple.split()))
        return b"".join(map(cache.__getitem__, text.split() if "\0" not in text else SOLID.findall(text)))

    encoded.vocabulary = tokenizer.get_vocab_size(with_added_tokens=True)
    return encoded
