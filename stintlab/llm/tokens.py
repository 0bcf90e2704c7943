"""Byte-pair ids of whole texts.

The ids are those of the byte-level BPE vocabulary ``byte_bpe_50k`` with no special tokens
added. The strings of ``added`` tokens in a text are one id each, as the tokenizer has it, and
what lies between them is encoded on its own; without any they are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Mapping

import numpy as np
import public_tokenizers
import regex
import tiktoken

VOCABULARY = "byte_bpe_50k.tiktoken"
# The tokenizer's added tokens, which the vocabulary's file does not list.
ADDED = {"<|endoftext|>": 50256}


class PieceTokens:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str | None = None, added: Mapping[str, int] | None = None):
        path = vocabulary or public_tokenizers.path(VOCABULARY)
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._added = dict(added or {})
        self._encoding = tiktoken.Encoding(
            "byte_bpe",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens=self._added,
        )

    def id_bytes(self, text: str) -> bytes:
        try:
            ids = self._encoding.encode_to_numpy(
                text, allowed_special=set(self._added), disallowed_special=()
            )
        except ValueError:
            # The encoder's own matching gives up on runs of some 100,000 white-space characters.
            ids = self._word_by_word(text)
        return np.asarray(ids, "<u4").tobytes()

    def _word_by_word(self, text: str) -> list[int]:
        longest_first = sorted(self._added, key=len, reverse=True)
        cut = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})" if self._added else "(?!)")
        word = regex.compile(public_tokenizers.PATTERN)
        ids: list[int] = []
        for part in cut.split(text):
            if part in self._added:
                ids.append(self._added[part])
            else:
                for found in word.finditer(part):
                    ids.extend(self._encoding._encode_single_piece(found.group()))
        return ids
