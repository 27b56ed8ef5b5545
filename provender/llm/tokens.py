"""Token ids of whole texts, with a bounded memory of words already encoded.

A byte-level vocabulary never merges across words as its own rule cuts them. Latin
words, numbers, plain marks and blanks are cut here by that rule in one pass over the
text, every distinct one goes once to the ``tokenizers`` library's merge model, and a
text's ids are its words' ids in order. A stretch with any other character, up to the
next blank, is encoded by the library as it stands, as is a whole text that holds an
added token or unusual blanks beside plain ones. The result equals encoding the text
in one call; for other kinds of tokenizer, texts are encoded in one call.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

#: Words remembered by one Python worker, and their characters.
ROOM = 800_000
ROOM_CHARS = 16_000_000

_BLANK = r" \t\n\r"
_OTHER_BLANK = r"\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER, _MARK = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
# Whole runs of one kind that no character outside the kinds below follows.
_RUN = rf" ?(?:[{_LETTER}]++|[0-9]++|[{_MARK}]++)(?![^{_BLANK}{_LETTER}0-9{_MARK}])"
# Blanks but for the last before a word; that one is the word's if it is a space.
_BLANKS = rf"[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]"
_WORD = re.compile(rf"{_RUN}| ?[^{_BLANK}]+|{_BLANKS}")
_UNUSUAL = re.compile(f"[{_OTHER_BLANK}]")
_MIXED = re.compile(f"[{_OTHER_BLANK}][{_BLANK}]|[{_BLANK}][{_OTHER_BLANK}]")
_PLAIN = re.compile(rf" ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+|[{_BLANK}]+")


class _Known(dict):
    """Ids by piece; a new piece is encoded when it is first asked for.

    When room runs out, what is held becomes the older half, which goes when room
    runs out again; a piece asked for meanwhile comes back from it.
    """

    def __init__(self, encode: Callable[[str], bytes], room: int, room_chars: int):
        super().__init__()
        self._encode, self._room, self._room_chars, self._chars = encode, room // 2, room_chars // 2, 0
        self._older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            ids = self._encode(piece)
        self[piece] = ids
        self._chars += len(piece)
        return ids

    def tidy(self) -> None:
        if len(self) > self._room or self._chars > self._room_chars:
            self._older = dict(self)
            self.clear()
            self._chars = 0


class Encoder:
    """Encodes lists of texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, room: int = ROOM, room_chars: int = ROOM_CHARS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        settings = json.loads(self._library.to_str())
        self._byte_level = _is_byte_level(settings)
        self._added = [a["content"] for a in settings["added_tokens"]]
        self._alphabet = str.maketrans(_byte_names())
        self._model = self._library.model
        self._known = _Known(self._word, room, room_chars)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as bytes; a null text is an empty one."""
        if not self._byte_level:
            found = self._library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [_bytes(e.ids) for e in found]
        known, out = self._known.__getitem__, []
        for text in texts:
            text = text or ""
            if any(a in text for a in self._added) or (_UNUSUAL.search(text) and _MIXED.search(text)):
                out.append(self._by_library(text))
            else:
                out.append(b"".join(map(known, _WORD.findall(text))))
            self._known.tidy()
        return out

    def _word(self, word: str) -> bytes:
        # The first test says the same of most words and is the quicker one.
        if not (word.isascii() and word.isprintable() and "'" not in word) and not _PLAIN.fullmatch(word):
            return self._by_library(word)
        named = word.encode().decode("latin-1").translate(self._alphabet)
        return _bytes([t.id for t in self._model.tokenize(named)])

    def _by_library(self, text: str) -> bytes:
        return _bytes(self._library.encode(text, add_special_tokens=False).ids)


def _is_byte_level(settings: dict) -> bool:
    before, model = settings["pre_tokenizer"] or {}, settings["model"]
    return (before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            and settings["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout")
            and not any(a["lstrip"] or a["rstrip"] or re.search(r"\s", a["content"]) for a in settings["added_tokens"]))


def _byte_names() -> dict[int, str]:
    """The character by which the library's byte-level models name each byte.

    A byte whose own character is in their alphabet keeps it; the other bytes have
    the alphabet's remaining characters, in order.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    alphabet = set(ByteLevel.alphabet())
    others = iter(sorted(c for c in alphabet if ord(c) > 255))
    return {b: chr(b) if chr(b) in alphabet else next(others) for b in range(256)}


def _bytes(ids: list[int]) -> bytes:
    held = array("I", ids)
    if sys.byteorder == "big":
        held.byteswap()
    return held.tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python process; workers keep it from task to task."""
    return Encoder(path)
