"""Byte-level BPE: vocabularies, special strings, safe cuts and fast encoding."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Before a space or line feed that follows a visible character, every pre-tokenizer of this kind
#: starts a new token, so a text may be cut there and its parts encoded on their own.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=2)
def _loaded(path: str, size: int, changed: int):
    return load(path)


def kept(path: str):
    """``load``, once per process while the file is unchanged. The library keeps what a tokenizer encoded, up to
    10,000 strings, and never frees that when the tokenizer goes: a worker that loads one per task grows with each."""
    now = os.stat(path)
    return _loaded(path, now.st_size, now.st_mtime_ns)


def special_strings(tok) -> dict[str, int]:
    return {t.content: i for i, t in tok.get_added_tokens_decoder().items()}


def special_split(tok) -> re.Pattern | None:
    """Pattern that cuts a text at the strings the library takes for special tokens."""
    found = sorted(special_strings(tok), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None


def segments(text: str, size: int = 1 << 20):
    """The text in parts of about ``size`` characters, cut only where tokens start."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _bytes_of_symbols() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in plain):
        out[chr(256 + i)] = b
    return out


class Encoder:
    """Ids of whole texts, the same as ``tokenizers`` gives for this byte-level vocabulary. The
    vocabulary is read by that library; ids are in the order of its merges, so the faster
    ``tiktoken`` merges by id. (A test holds the two against each other.)"""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.tok = load(path)
        self.special, self.ids = special_split(self.tok), special_strings(self.tok)
        symbols = _bytes_of_symbols()
        ranks = {bytes(symbols[c] for c in w): i for w, i in self.tok.get_vocab(with_added_tokens=False).items() if w not in self.ids}
        self.merged = tiktoken.Encoding("from file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        out: list[np.ndarray] = [np.zeros(0, "<u4")]
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                out.append(np.array([self.ids[part]], "<u4"))
            elif part:
                out += [np.array(self.merged.encode_ordinary(s), "<u4") for s in segments(part)]
        return np.concatenate(out)
