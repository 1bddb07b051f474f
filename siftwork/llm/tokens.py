"""Token counts and places by a public tokenizer. The vocabulary's path is a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

#: Folder with the public vocabularies, and the one that sizes are measured with.
FOLDER = os.environ.get("SIFTWORK_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: the pattern by which this vocabulary's text is divided before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A text is tokenized in stretches of about this many characters, cut where the pattern surely divides.
STRETCH = 200_000


def vocabulary_path(name: str = VOCABULARY, folder: str = FOLDER) -> str:
    return os.path.join(folder, name)


@lru_cache(maxsize=4)
def _load(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, k in ranks.items():
        lengths[k] = len(token)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def _stretches(text: str) -> list[str]:
    """The text cut before a blank that stands between two characters other than white space: the pattern always
    divides there, so the tokens are those of the whole text."""
    out, at = [], 0
    while len(text) - at > STRETCH:
        k = at + STRETCH
        while k < len(text) - 1 and not (text[k] == " " and not text[k - 1].isspace() and not text[k + 1].isspace()):
            k += 1
        if k >= len(text) - 1:
            break
        out.append(text[at:k])
        at = k
    out.append(text[at:])
    return out


def _clean(text: str) -> str:
    return text if text.isascii() else text.encode("utf-8", "replace").decode()


def count(text: str | None, path: str) -> int:
    """Tokens of a text; 0 for a null or empty one."""
    if not text:
        return 0
    enc, _ = _load(path)
    return sum(len(enc.encode_ordinary(x)) for x in _stretches(_clean(text)))


def ends(text: str, path: str) -> tuple[str, np.ndarray]:
    """The text as it was tokenized, and the character offset at which each token ends; -1 where a token ends inside a
    character."""
    enc, lengths = _load(path)
    text = _clean(text)
    ids = np.concatenate([np.array(enc.encode_ordinary(x), dtype=np.int64) for x in _stretches(text)])
    at = np.cumsum(lengths[ids])
    if text.isascii():
        return text, at
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    first = (raw & 0xC0) != 0x80
    chars = np.concatenate([np.cumsum(first) - first, [len(text)]])
    inside = np.concatenate([~first, [False]])
    return text, np.where(inside[at], -1, chars[at])
