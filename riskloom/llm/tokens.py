"""Token ids of whole texts through the ``tokenizers`` library, word by word.

A tokenizer that drops white space and never lets a piece span it gives the
same ids for a text as for its blank-separated words one after the other.
`DocEncoder` uses that: every distinct word of a Python worker is encoded
once by the library and looked up afterwards; the words of many texts are
split, numbered and put together again as Arrow and NumPy columns, and those
not met before go to the library together.  Tokenizers of another kind go
through the library text by text.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import utf8

#: The splitting rule (fixed value of the file format) that never crosses white space.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Marks that form one piece of their own after a word character: no letters, digits, or parts of "'s" or of a special string's end.
MARKS = b".,;:!?|)#$%&*\"+-/=@\\]^_`}~"
#: Below this, letters keep their case rules in every version of Unicode, and lowering one gives one letter.
LATIN_END = "\u0130"
#: Stands between letters-only words that go to the library together: no letter has it among its bytes.
BETWEEN = "!"


@functools.cache
def load(path: str):
    """The library's tokenizer for a ``.json`` file, one per process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def by_word(path: str) -> bool:
    """Whether ids of a text are the ids of its ASCII-blank separated words."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    split, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and split.get("pattern") == {"Regex": WORD_SPLIT}
        and split.get("behavior") == "Removed" and split.get("invert") is True
        and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in rest] == [("ByteLevel", False, False)]
        and all(not x["lstrip"] and not x["rstrip"] and not x["single_word"] and not x["normalized"]
                and not any(c.isspace() for c in x["content"]) for x in spec["added_tokens"])
    )


def _byte_names() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable Latin-1, else 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(others)}}


BYTE_NAMES = _byte_names()


def byte_level(text: str) -> str:
    """A text as byte-level models see it."""
    return text.encode("utf-8", "replace").decode("latin-1").translate(BYTE_NAMES)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class DocEncoder(dict):
    """Ids of texts as little-endian unsigned 32-bit integers in bytes.

    As a dict it holds the ids of words met lately.  After ``room`` words it
    starts anew, and words of the last round come back from it at first sight,
    so a worker's memory is bounded whatever the corpus holds.
    """

    def __init__(self, path: str, room: int = 400_000) -> None:
        super().__init__()
        self.tok, self.words, self.room, self.old = load(path), by_word(path), room, {}
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(self.special) if self.special else b"\0"

    def whole(self, raw: bytes) -> bytes:
        return packed(self.tok.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids)

    @functools.cached_property
    def joined(self) -> tuple:
        """The library's tokenizer of the same model for byte-level words with `BETWEEN` between them, and the ids of that."""
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer(self.tok.model)
        plain.pre_tokenizer = pre_tokenizers.Split(BETWEEN, "isolated")
        return plain, [t.id for t in self.tok.model.tokenize(BETWEEN)]

    def parts(self, word: bytes) -> tuple[bytes, bytes]:
        """A word and the marks at its end that are a piece of their own (or nothing)."""
        base = word.rstrip(MARKS)
        return (base, word[len(base):]) if len(base) < len(word) and base[-1:].isalnum() else (word, b"")

    def letters(self, word: bytes) -> str:
        """The word in lower case if it is letters only: one piece, and lower case is letter by letter; else nothing."""
        if word.isalpha():
            return word.lower().decode()
        if self.mark in word:
            return ""
        text = word.decode("utf-8", "replace")
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return text.lower() if text.isalpha() and max(text) < LATIN_END else ""

    def fresh(self, word: bytes) -> bytes:
        base, marks = self.parts(word)
        if marks:
            return self[base] + self[marks]
        if text := self.letters(word):
            return packed([t.id for t in self.tok.model.tokenize(byte_level(text))])
        return self.whole(word)

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.fresh(word)
        self.renew()
        self[word] = ids
        return ids

    def renew(self) -> None:
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()

    def learn(self, words: Iterable[bytes], at_once: int = 256) -> None:
        """Ids of the letters-only words among new ``words``, ``at_once`` words a text of the library."""
        plain, between = self.joined
        if len(between) != 1:
            return  # they are looked up one by one
        texts = {w: text for w in words if (text := self.letters(w))}
        names = list(texts)
        for i in range(0, len(names), at_once):
            self.renew()
            some = names[i:i + at_once]
            text = byte_level(BETWEEN.join([texts[w] for w in some]))
            ids = np.array(plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = [*(4 * np.flatnonzero(ids == between[0])).tolist(), 4 * len(ids)]
            raw, start = ids.tobytes(), 0
            for word, end in zip(some, ends, strict=True):
                self[word] = raw[start:end]
                start = end + 4

    def look_up(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; marks at a word's end are looked up apart."""
        found = list(map(self.get, words))
        bases, marks = {}, {}
        for i, ids in enumerate(found):
            if ids is None:
                bases[i], marks[i] = self.parts(words[i])
        self.learn({w for w in bases.values() if w not in self and w not in self.old})
        for i, base in bases.items():
            found[i] = self[base] + self[marks[i]] if marks[i] else self[base]
        return found

    def all(self, texts: pa.Array) -> list[bytes]:
        """`ids` of every text of an Arrow column (null: empty)."""
        if not self.words or not self.mark:
            return [self.ids(raw) for raw in utf8(texts)]
        special = pc.fill_null(pc.match_substring(texts, self.mark.decode()), False)
        plain = pc.if_else(special, pa.scalar("", texts.type), pc.fill_null(texts, ""))
        words = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        coded = words.flatten().dictionary_encode()
        found = self.look_up(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each, of_word = np.frombuffer(b"".join(found), "<u4"), coded.indices.to_numpy()
        n = sizes[of_word]
        ends = np.concatenate([[0], np.cumsum(n)])
        shift = (np.cumsum(sizes) - sizes)[of_word] - ends[:-1]  # from a place in the output to one in `each`
        raw = each[np.arange(ends[-1]) + np.repeat(shift, n)].tobytes()
        to = 4 * ends[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])]
        out = [raw[a:b] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.ids(utf8(texts.slice(i, 1))[0])
        return out

    def ids(self, raw: bytes) -> bytes:
        if not self.words or not self.mark:
            return self.whole(raw)
        if self.mark not in raw:  # else a lowered string might become a special one
            raw = raw.lower()
        return b"".join([self[w] for w in raw.split()])


@functools.cache
def encoder(path: str) -> DocEncoder:
    """One encoder per Python worker, kept from task to task."""
    return DocEncoder(path)
