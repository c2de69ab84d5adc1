"""Splitting text into the words that byte-pair merges stay within."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

#: Text of these characters alone is split by the standard library, which is faster; there both agree.
_PLAIN = re.compile("[^\t\n\x0b\x0c\r\x20-\x7eÀ-ÖØ-öø-ɏ]")

# Fixed value: the pattern of the published lower-case vocabulary, for plain text; a line end stands alone.
_WORD_PLAIN = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

#: Kinds of the bytes of plain text; those above 127 are of letters.
_SIGN, _WHITE, _DIGIT, _LETTER, _QUOTE = range(5)
_KIND = np.array([_LETTER if b > 127 or chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _WHITE if b in (9, 10, 11, 12, 13, 32) else _QUOTE if b == 39 else _SIGN for b in range(256)], np.uint8)


class WordSplit:
    """The words of each run of text, in bytes.

    Plain text is lowered and split by the standard library, all of it at once; all other text by the
    vocabulary file's own normaliser and pre-tokenizer, since every library knows another version of Unicode.
    """

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        file = Tokenizer.from_str(spec)
        self.normal, self.pre = file.normalizer.normalize_str, file.pre_tokenizer.pre_tokenize_str
        self.bytes_of = {c: b for b, c in enumerate(byte_letters())}

    def __call__(self, runs: list[bytes]) -> list[list[bytes]]:
        text = [r.decode() for r in runs]
        plain = [is_plain(x) for x in text]
        # Runs hold no line ends, so these tell them apart.
        found = iter(_WORD_PLAIN.findall("".join([x + "\n" for x, p in zip(text, plain, strict=True) if p]).lower()))
        return [[w.encode() for w in iter(found.__next__, "\n")] if p else self._other(x) for x, p in zip(text, plain, strict=True)]

    def _other(self, text: str) -> list[bytes]:
        return [bytes([self.bytes_of[c] for c in w]) for w, _ in self.pre(self.normal(text))]


def is_plain(text: str) -> bool:
    return not _PLAIN.search(text)


def byte_level_pieces(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Plain texts cut where the byte-level pattern is sure to start a word, and where each text's pieces start.

    That is: before white space after something else; between letters, digits and signs, but not beside an
    apostrophe; after one white space character, not a space, that stands alone. A word never crosses such a
    place and white space before it has its end in the piece, so pieces are split as the whole text is.
    """
    data = [x.encode() for x in texts]
    at = np.concatenate([[0], np.cumsum([len(x) for x in data], dtype=np.int64)])
    text = np.frombuffer(b"".join(data), np.uint8)
    kind = _KIND[text]
    white = kind == _WHITE
    cut = np.zeros(len(text), bool)
    cut[1:] = (kind[1:] != kind[:-1]) & ~white[:-1] & (white[1:] | (kind[1:] != _QUOTE) & (kind[:-1] != _QUOTE))
    alone = white & (text != 32)
    alone[1:] &= ~white[:-1]
    cut[1:] |= alone[:-1] & ~white[1:]
    # What a text's first character follows is of another text.
    first = at[:-1][at[1:] > at[:-1]]
    cut[first] = True
    second = first[first + 1 < len(text)]
    cut[second + 1] |= white[second] & (text[second] != 32) & ~white[second + 1]
    starts = np.flatnonzero(cut)
    offsets = pa.py_buffer(np.concatenate([starts, [len(text)]]).astype(np.int64))
    return pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(text)), np.searchsorted(starts, at)


def byte_letters() -> list[str]:
    """For every byte the letter that stands for it in a vocabulary: itself if printable, else the next one from U+0100."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]
