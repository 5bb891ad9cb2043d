"""Token ids of a public byte-level BPE vocabulary, whose files are a parameter."""

from __future__ import annotations

import base64
import functools

import numpy as np
import tiktoken

#: Fixed value: how the vocabulary's authors split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Fixed value: the special token that the vocabulary's own settings know.
SPECIAL = {"<|endoftext|>": 50256}


@functools.lru_cache(maxsize=4)
def encoder(path: str, special: bool = False) -> tiktoken.Encoding:
    """The encoder of a vocabulary file of base64 tokens and ranks; one for each Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL if special else {})


def encode(text: str | None, path: str, special: bool = False) -> np.ndarray:
    """Ids as unsigned 32-bit numbers. A null text is an empty one. With ``special`` the strings of SPECIAL are its ids,
    otherwise nothing in a text is special."""
    if not text:
        return np.empty(0, np.uint32)
    allowed = "all" if special else set()
    return np.asarray(encoder(path, special).encode_to_numpy(text, allowed_special=allowed, disallowed_special=()), np.uint32)
