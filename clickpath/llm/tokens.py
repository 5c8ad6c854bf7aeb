"""Token ids from a public tokenizer file, through the tokenizers library.

A byte-level BPE splits a text by a fixed pattern and encodes each piece on its
own, so the ids of a piece never depend on its neighbours. ``Encoder`` makes use
of that. Many texts are cut into pieces at once, by the classes of neighbouring
characters in numpy; Arrow's dictionary encoding finds the distinct pieces, and only
those are looked up: in a bounded cache of the tokenizer's own answers, or else by
asking its model. Tokenizer files of any other kind are given whole texts.
"""

from __future__ import annotations

import codecs
import functools
import json
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

# Fixed value: the split pattern of byte-level BPE.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed rule: byte-level BPE writes a printable Latin-1 byte as its own character
# and the n-th of all other bytes as character 256 + n.
_PRINTABLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_OTHERS = sorted(set(range(256)).difference(_PRINTABLE))
BYTE_SYMBOLS = "".join(chr(256 + _OTHERS.index(b)) if b in _OTHERS else chr(b) for b in range(256))

# Pieces in each of the two generations of the cache.
CACHE_PIECES = 160_000

# Longest piece that is remembered, in UTF-8 bytes: 64 characters of three.
CACHE_PIECE_BYTES = 192

# Characters that are cut into pieces at once.
CHARS_AT_ONCE = 1 << 19

# Classes of characters in the split pattern.
LETTER, NUMBER, OTHER, SPACE, EDGE = range(5)


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point, as the regular expressions see it."""
    every = "".join(map(chr, range(0x110000)))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = kind
    return out


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pieces of BYTE_LEVEL_SPLIT begin in the code points of texts put side by side.

    ``text_starts`` are the first places of the texts, none of them empty. A piece begins
    where the class changes; the last of some white space before another character
    is cut off, and if it is a blank it leads that character's piece instead. An
    apostrophe that begins a piece takes a contraction's letters.
    """
    if not len(points):
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    before = np.concatenate([[EDGE], kind[:-1]])
    before[text_starts] = EDGE
    begins = kind != before
    after_space = np.flatnonzero((before == SPACE) & (kind != SPACE))
    begins[after_space - 1] = True
    begins[after_space[points[after_space - 1] == ord(" ")]] = False
    quotes = np.flatnonzero((points == ord("'")) & begins)
    if len(quotes):
        ends = np.append(text_starts[1:], len(points))[np.searchsorted(text_starts, quotes, "right") - 1]
        ahead = np.concatenate([points, np.zeros(2, points.dtype)])
        first = np.where(quotes + 1 < ends, ahead[quotes + 1], 0)
        second = np.where(quotes + 2 < ends, ahead[quotes + 2], 0)
        short = np.isin(first, [ord(x) for x in "stmd"])
        long = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (first == ord(a)) & (second == ord(b))
        begins[quotes[short | long] + 1] = False
        stops = np.concatenate([quotes[short] + 2, quotes[long] + 3])
        begins[stops[stops < len(points)]] = True
    return np.flatnonzero(begins)


class _Remembered:
    """Answers of ``ask`` by piece, in two generations: the newer one begins anew when it holds CACHE_PIECES."""

    def __init__(self, ask: Callable[[list[bytes]], list[bytes]]) -> None:
        self._ask = ask
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def answers(self, pieces: list[bytes]) -> list[bytes]:
        """The answers to distinct pieces, in order; ``ask`` gets all that neither generation holds at once."""
        if len(self._new) > CACHE_PIECES:
            self._new, self._old = {}, self._new
        out = list(map(self._new.get, pieces))
        places = [k for k, x in enumerate(out) if x is None]
        keys = [pieces[k] for k in places]
        held = list(map(self._old.get, keys))
        asked = iter(self._ask([key for key, x in zip(keys, held) if x is None]))
        for k, key, x in zip(places, keys, held):
            out[k] = x = next(asked) if x is None else x
            if len(key) <= CACHE_PIECE_BYTES:
                self._new[key] = x
        return out


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    With ``added_tokens`` the ids are those of the library's ``encode`` without special
    tokens around the text: a string that the file lists as an added token has that
    token's id. Without, special tokens' strings are ordinary text. Empty text has no ids.
    """

    def __init__(self, path: str, added_tokens: bool = False) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not added_tokens
        split = spec.get("pre_tokenizer") or {}
        self._by_piece = (spec.get("normalizer") is None and split.get("type") == "ByteLevel"
                          and split.get("use_regex", True) and not split.get("add_prefix_space", True))
        added = [t for t in spec.get("added_tokens") or () if added_tokens or not t.get("special")]
        self._by_piece &= not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip"))
        self._added = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        # Of tokens that begin at one place the longest counts.
        self._at_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self._added, key=len, reverse=True))) + ")").split
        self._pieces = _Remembered(self._model_ids)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order; some CHARS_AT_ONCE characters are worked on at a time."""
        held: list[str] = []
        size = 0
        for text in texts:
            alone = not self._by_piece or len(text) > CHARS_AT_ONCE or any(t in text for t in self._added)
            if held and (alone or size + len(text) > CHARS_AT_ONCE):
                yield from self._side_by_side(held)
                held, size = [], 0
            if alone:
                yield self._whole(text)
            else:
                held.append(text)
                size += len(text)
        if held:
            yield from self._side_by_side(held)

    def _whole(self, text: str) -> bytes:
        if not self._by_piece:
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if any(t in text for t in self._added):
            # Every second part is an added token; what lies between is split on its own.
            return b"".join(self._added[x] if k % 2 else self._plain(x) for k, x in enumerate(self._at_added(text)))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        """The ids of a text without added tokens, of any length."""
        return b"".join(self._side_by_side([x])[0] for x in _stretches(text))

    def _side_by_side(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without added tokens."""
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        starts = piece_starts(points, (ends - lengths)[lengths > 0])
        # The pieces as slices of the UTF-8 bytes.
        data = whole.encode()
        if len(data) == len(points):
            offsets = np.append(starts, len(data))
        else:
            sizes = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
            offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[np.append(starts, len(points))]
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        which = pieces.indices.to_numpy()
        answers = self._pieces.answers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        counts = np.fromiter(map(len, answers), np.int64, len(answers)) // 4
        known = np.frombuffer(b"".join(answers), "<u4")
        n = counts[which]
        upto = np.cumsum(n)
        ids = known[np.repeat((np.cumsum(counts) - counts)[which] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)]
        cuts = np.append(0, upto)[np.searchsorted(starts, np.append(0, ends))].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _model_ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, from the tokenizer's model."""
        symbols = codecs.charmap_decode(b"".join(pieces), "strict", BYTE_SYMBOLS)[0]  # a character for each byte
        tokenize = self._tokenizer.model.tokenize
        ids, cuts, at = array("I"), [0], 0
        for piece in pieces:
            ids.extend([t.id for t in tokenize(symbols[at:at + len(piece)])])
            at += len(piece)
            cuts.append(4 * len(ids))
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def _stretches(text: str) -> Iterator[str]:
    """A text in stretches of about CHARS_AT_ONCE characters, cut before a lone blank, where a piece begins in any case."""
    at, blank = 0, regex.compile(r"(?<=\S) (?=\S)")
    while len(text) - at > CHARS_AT_ONCE and (m := blank.search(text, at + CHARS_AT_ONCE)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker, which knows the file's added tokens."""
    return Encoder(path, added_tokens=True)


def default_tokenizer() -> str:
    """Where the 50,257-token byte-level BPE of the public tokenizers package lies."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
