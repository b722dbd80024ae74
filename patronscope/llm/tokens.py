"""Token ids of a public byte-level tokenizer, quickly.

``tiktoken`` gives the same ids as the tokenizer itself where both put every character in the
same class, several times faster. So a text is cut at spaces between two printable ASCII characters,
where no token crosses; runs of plain Latin text are encoded from the same vocabulary as ranks,
runs with other characters by the tokenizer. Whole plain texts are one run.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache
from itertools import groupby

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY_SIZE = 50_257
#: Characters whose class is the same in every version of Unicode.
_PLAIN = re.compile("[ \n!-~À-ÖØ-öø-ɏ]+")
_CUT = re.compile("(?<=[!-~])(?= [!-~])")
_SPECIAL = "<|endoftext|>"


def folder() -> str:
    import public_tokenizers

    return os.path.dirname(public_tokenizers.path(VOCABULARY))


def ranks(vocabularies: str) -> dict[bytes, int]:
    """The bytes of every id but the special one."""
    with open(os.path.join(vocabularies, RANKS), "rb") as f:
        return {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}


class Encoder:
    """Ids as 16-bit numbers; ``special``: the special token's string in a text is its id."""

    def __init__(self, vocabularies: str, special: bool = True) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.special = special
        self.tokenizer = Tokenizer.from_file(os.path.join(vocabularies, VOCABULARY))
        self.tokenizer.encode_special_tokens = not special
        self.plain = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks(vocabularies),
            special_tokens={},
        ).encode_ordinary

    def _by_tokenizer(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        """The ids of a whole text; the same as the tokenizer gives."""
        if _PLAIN.fullmatch(text) and not (self.special and _SPECIAL in text):
            found = self.plain(text)
        elif self.special and _SPECIAL in text:
            found = self._by_tokenizer(text)
        else:
            found = []
            runs = groupby(_CUT.split(text), lambda part: bool(_PLAIN.fullmatch(part)))
            for is_plain, run in runs:
                found += (self.plain if is_plain else self._by_tokenizer)("".join(run))
        return np.array(found, "<u2")

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 16-bit numbers."""
        return self.ids(text).tobytes()


@lru_cache(maxsize=2)
def encoder(vocabularies: str, special: bool = True) -> Encoder:
    return Encoder(vocabularies, special)
