"""The public byte-level BPE vocabulary, as token ids of whole texts."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: Vocabulary file of the ids and the same vocabulary as ranks.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def encoder(ranks_path: str | None = None):
    """Encoder of the vocabulary; strings of special tokens are ordinary text.

    The ranks give the same ids as the vocabulary file with the tokenizers
    library (tested) in a seventh of the time.
    """
    import public_tokenizers
    import tiktoken
    with open(ranks_path or public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@lru_cache(maxsize=2)
def token_lengths(ranks_path: str | None = None) -> np.ndarray:
    """Bytes of every token, by id."""
    enc = encoder(ranks_path)
    out = np.zeros(enc.n_vocab, dtype=np.int64)
    for token in enc.token_byte_values():
        out[enc.encode_single_token(token)] = len(token)
    return out


def encode(text: str | None, ranks_path: str | None = None) -> np.ndarray:
    """Token ids (uint32) of a whole text; none for null or empty."""
    if not text:
        return np.empty(0, dtype=np.uint32)
    return np.asarray(encoder(ranks_path).encode_to_numpy(text), dtype=np.uint32)
