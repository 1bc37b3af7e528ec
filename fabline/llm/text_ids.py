"""Token ids of whole texts by a public tokenizer."""

from __future__ import annotations

import re

import numpy as np

SPECIAL = "<|endoftext|>"
BEYOND = re.compile("[^\x00-\u024f]")
BLANKS = re.compile(r"\s{1000}")  # the pattern's lookahead goes back over a run of blanks one by one


class TextIds:
    """Token ids of whole texts as little-endian unsigned 32-bit numbers.

    The vocabulary's rank file, where one is given, encodes plain Latin texts; texts with the special string, with
    other letters or with very long runs of blanks go to the tokenizer, which is loaded only then.
    """

    def __init__(self, tokenizer_file: str, rank_file: str | None = None):
        self.file, self.tok, self.fast = tokenizer_file, None, None
        if rank_file:
            import base64

            import public_tokenizers
            import tiktoken

            with open(rank_file, "rb") as f:
                ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> np.ndarray:
        if self.fast and SPECIAL not in text and not BEYOND.search(text) and not BLANKS.search(text):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        if self.tok is None:
            from tokenizers import Tokenizer

            self.tok = Tokenizer.from_file(self.file)
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
