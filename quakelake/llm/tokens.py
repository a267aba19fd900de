"""Token ids of whole texts, with a cache of the words met before.

The tokenizers used here never join characters across a border between a character that is not
white space and a blank or line feed after it, nor between a line feed and a word, nor between a
letter and a full stop or the like. So the ids of a text whose words are parted by single blanks and
line feeds are those of its words, one after another, each with the blank or line feed before it.
Many texts are cut at once, in Arrow's own buffers, and only their distinct words are looked up; each
word is encoded once while it stays in the cache. Texts with other white space between words are cut
into pieces in the same way, more slowly, unless the tokenizer drops white space; those with white
space of another kind, or with a special token's string, are encoded in one piece.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quakelake.llm.support import kept

# Words of one of the two generations of a cache, and the longest word that one holds: a cache has
# a bound in bytes, whatever the texts.
CACHE_WORDS = 3 << 17
LONGEST_WORD = 64
# Bytes of texts that are cut at once.
CUT_BYTES = 1 << 19
# Words that are encoded as one text.
_TOGETHER = 100
# Kinds of bytes: those that begin a word, those that do behind a letter, and letters. An apostrophe can
# go with the letters after it.
_PARTS, _STOPS, _IS_LETTER = 1, 2, 3
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b" \n")] = _PARTS
_KINDS[list(string.punctuation.replace("'", "").encode())] = _STOPS
_KINDS[list(string.ascii_letters.encode())] = _IS_LETTER
# First byte of À to ÿ, all of them letters but for two, by their second byte.
_LATIN, _TIMES, _DIVIDED = 0xC3, 0x97, 0xB7
_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# For tokenizers that lower letters and drop white space: fewer words differ.
_LOWERED = bytes.maketrans(string.ascii_uppercase.encode() + b"\n", string.ascii_lowercase.encode() + b" ")
# For Arrow's regular expressions: white space besides blanks and line feeds, and such blanks and line
# feeds as do not part two words singly.
_OTHER_SPACE = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_UNEVEN = r"\A[ \n]|[ \n]\z|[ \n][ \n]"


def tokenizer_path(name: str) -> str:
    """Path of a tokenizer file that is installed with the workers' Python."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _lowers_and_drops(parts: dict) -> bool:
    """Whether a tokenizer file says that letters are lowered and white space gives no ids.

    It does if a step lowers, and if words are what a pattern finds that white space cannot match.
    """
    steps = (parts["normalizer"] or {}).get("normalizers", [parts["normalizer"]])
    splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [parts["pre_tokenizer"]])
    first = splits[0] or {}
    found_only = first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
    matched = found_only and re.search(r"(?<!\^)\\s", first["pattern"].get("Regex", r"\s"))
    return any(step and step["type"] == "Lowercase" for step in steps) and bool(found_only) and not matched


class _Words:
    """Ids of words, in two generations: what is not met again is forgotten."""

    def __init__(self, encode) -> None:
        self._encode = encode
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def ids(self, words: list[str]) -> list[bytes]:
        if len(self._young) > CACHE_WORDS:
            self._old, self._young = self._young, {}
        found = list(map(self._young.get, words))
        if None in found:
            places = [at for at, known in enumerate(found) if known is None]
            for at, ids in zip(places, self._learn([words[at] for at in places])):
                found[at] = ids
        return found

    def rest(self) -> None:
        """Forget the older generation, while no task runs."""
        self._old = {}

    def _learn(self, words: list[str]) -> list[bytes]:
        found = list(map(self._old.get, words))
        new = iter(self._encode([word for word, known in zip(words, found) if known is None]))
        found = [next(new) if known is None else known for known in found]
        self._young.update((word, ids) for word, ids in zip(words, found) if len(word) <= LONGEST_WORD)
        return found


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, without special tokens."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Asked of the tokenizer, as reading its whole file again, vocabulary and all, takes much memory.
        steps = {"normalizer": self._tokenizer.normalizer, "pre_tokenizer": self._tokenizer.pre_tokenizer}
        self._lowers = _lowers_and_drops(
            {name: None if step is None else json.loads(step.__getstate__()) for name, step in steps.items()}
        )
        # Strings that the tokenizer takes out of a text before anything else; none if empty.
        added = self._tokenizer.get_added_tokens_decoder()
        self._whole_only = "|".join([_OTHER_SPACE, *(f"(?i:{re.escape(token.content)})" for token in added.values())])
        # One of them that no other text gives the id of, and that takes nothing from the text around it.
        size = self._tokenizer.get_vocab_size(with_added_tokens=False)
        plain = [
            (number, token.content)
            for number, token in added.items()
            if number >= size and not (token.normalized or token.single_word or token.lstrip or token.rstrip)
        ]
        self._border = min(plain, default=None)
        self._bare = _Words(self._encode)
        self._spaced = _Words(self._encode)

    def _encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word, of many at a time: the tokenizer takes long to begin with a text."""
        if self._border is None:
            return [self.whole(word) for word in words]
        number, content = self._border
        joined = [content.join(words[at : at + _TOGETHER]) for at in range(0, len(words), _TOGETHER)]
        found: list[bytes] = []
        for each in self._tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(each.ids, "<u4")
            ends = np.flatnonzero(ids == number)
            payload = ids.tobytes()
            starts = [0, *((ends + 1) * 4).tolist()]
            found += [payload[a:b] for a, b in zip(starts, [*(ends * 4).tolist(), len(payload)])]
        return found

    def rest(self) -> None:
        """Give up memory at the end of a task: its worker may go on with other work."""
        self._bare.rest()
        self._spaced.rest()

    def whole(self, text: str) -> bytes:
        """The ids of a text encoded in one piece."""
        ids = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; a null text is empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at, before = 0, 0
        while at < len(texts):
            upto = max(int(np.searchsorted(ends, before + CUT_BYTES, "right")), at + 1)
            yield from self._encode_some(texts.slice(at, upto - at))
            at, before = upto, ends[upto - 1]

    def _encode_some(self, texts: pa.Array) -> list[bytes]:
        whole = pc.match_substring_regex(texts, self._whole_only)
        odd = whole if self._lowers else pc.or_(whole, pc.match_substring_regex(texts, _UNEVEN))
        if not pc.any(odd).as_py():
            return self._cut(texts)
        even = iter(self._cut(texts.filter(pc.invert(odd))))
        strange = iter(texts.filter(odd).to_pylist())
        found = []
        for is_odd, is_whole in zip(odd.to_pylist(), whole.to_pylist()):
            if not is_odd:
                found.append(next(even))
            elif is_whole:
                found.append(self.whole(next(strange)))
            else:
                found.append(b"".join(self._bare.ids(_PIECE.findall(next(strange)))))
        return found

    def _cut(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts that are those of their words, each with the blank or line feed before it.

        What follows the letters of a word from a full stop or the like on is a word of its own.
        """
        texts = pa.concat_arrays([texts, pa.array([""], texts.type)])  # without what a slice leaves out
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts)]
        size = int(offsets[-1])
        if not size:
            return [b""] * (len(texts) - 1)
        payload = texts.buffers()[2][:size]
        if self._lowers:
            payload = pa.py_buffer(payload.to_pybytes().translate(_LOWERED))
        characters = np.frombuffer(payload, np.uint8)
        kinds, before = _KINDS[characters], characters[:-1]
        begins, letters = kinds == _PARTS, kinds == _IS_LETTER
        letters[1:] |= (before == _LATIN) & (characters[1:] != _TIMES) & (characters[1:] != _DIVIDED)
        begins[1:] |= (kinds[1:] == _STOPS) & letters[:-1]
        begins[offsets[offsets < size]] = True
        cuts = np.append(np.flatnonzero(begins), size)
        words = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), payload)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._spaced.ids(distinct), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(cuts, offsets)].tolist()
        taken = memoryview(ids.buffers()[2] or b"")
        return [taken[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def encoder_name(path: str) -> str:
    """Under what name a worker keeps the encoder of a file."""
    return f"encoder of {path}"


def encoder(path: str) -> Encoder:
    """The encoder of a file, one for each worker."""
    return kept(encoder_name(path), lambda: Encoder(path))
