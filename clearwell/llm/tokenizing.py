"""Encoders of the public vocabulary files, one per file and Python worker."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable
from functools import lru_cache

import public_tokenizers

#: Below this code point the character classes that split text are the same in both libraries.
SAME_CLASSES = "ɐ"


@lru_cache(maxsize=4)
def _library_encoder(file: str) -> Callable[[str], list[int]]:
    path = public_tokenizers.path(file)
    if file.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: pieces.encode(text, num_threads=1)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=4)
def encoder(file: str) -> Callable[[str], list[int]]:
    """A function that gives the token ids of a text as the file's own library does by default.

    The byte-level vocabulary also exists as ranks, whose encoder is some four times as fast and gives the same
    tokens. It takes the texts of Latin characters; all others go to the file's own library.
    """
    exact = _library_encoder(file)
    if file != "byte_bpe_50k.json":
        return exact
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(public_tokenizers.path(file)) as source:
        special = {t["content"]: t["id"] for t in json.load(source)["added_tokens"] if t["special"]}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )

    def encode(text: str) -> list[int]:
        if not text.isascii() and max(text) >= SAME_CLASSES:
            return exact(text)
        if any(s in text for s in special):
            return fast.encode(text, allowed_special="all")
        return fast.encode_ordinary(text)

    return encode


@lru_cache(maxsize=4)
def vocabulary(file: str) -> tuple[int, int]:
    """Number of ids, and the id that fills up sequences."""
    path = public_tokenizers.path(file)
    if file.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size(), 0
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(path).get_vocab_size()
    return size, size - 1


@lru_cache(maxsize=4)
def tokenizer_version(file: str) -> str:
    with open(public_tokenizers.path(file), "rb") as source:
        return hashlib.file_digest(source, "sha256").hexdigest()
