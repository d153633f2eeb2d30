"""Ids and token bytes of public vocabularies, loaded once per Python worker."""

from __future__ import annotations

import base64
import os
import re
from functools import cached_property, lru_cache

import numpy as np


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ByteVocabulary:
    """A byte-level BPE vocabulary.

    Whole texts are encoded with the rank file beside the vocabulary where
    there is one (the same merges, faster); texts that hold the special
    token's string go to the vocabulary's own library unless that string
    counts as plain text.
    """

    special = "<|endoftext|>"  # the one special token of the default vocabulary

    def __init__(self, path: str):
        self.path = path
        self.fast, self.ranks = None, None
        rank_file = re.sub(r"\.json$", ".tiktoken", path)
        if rank_file != path and os.path.exists(rank_file):
            import public_tokenizers
            import tiktoken

            with open(rank_file, "rb") as f:
                self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=self.ranks, special_tokens={})

    def _library(self, plain: bool):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = plain
        return tokenizer

    @cached_property
    def whole(self):
        return self._library(False)

    @cached_property
    def plain(self):
        return self._library(True)

    def ids(self, text: str | None, plain: bool = False) -> np.ndarray:
        """Unsigned 32-bit ids of a text without added special tokens; null has none.
        ``plain`` treats the special token's string inside a text as ordinary text."""
        if not text:
            return np.zeros(0, "<u4")
        if self.fast is not None and (plain or self.special not in text):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        library = self.plain if plain else self.whole
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """Bytes of every id; ids without an entry are empty."""
        if self.ranks is not None:
            table = self.ranks
        else:
            table = {_byte_level(t): i for t, i in self.whole.get_vocab(with_added_tokens=False).items()}
        out = [b""] * (max(table.values()) + 2)
        for token, i in table.items():
            out[i] = token
        return out


def _byte_level(token: str) -> bytes:
    """Bytes that a byte-level entry stands for: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    return bytes(_byte_letters()[c] for c in token)


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class PieceVocabulary:
    """A sentencepiece model; its encoder puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, text: str | None) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1) if text else [], "<u4")

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """Bytes of every id: the piece with U+2581 as a space, ``<0xHH>`` as that byte."""
        out = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                out.append(bytes([int(piece[3:5], 16)]))
            else:
                out.append(piece.replace("▁", " ").encode())
        return out


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


@lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)
