"""Token ids of a public byte-level BPE vocabulary.

``tokenizers`` defines the ids. ``tiktoken`` merges the same vocabulary by the same piece
pattern in a third of the time, so it encodes all texts but those that hold the string of a
special token; the tests hold the two libraries against each other.
"""

from __future__ import annotations

import base64
import os
import re

import numpy as np

DEFAULT_FILE = "byte_bpe_50k.json"
RANKS_SUFFIX = ".tiktoken"


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    """Place of an installed public vocabulary file; equal on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Equals ``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``.

    Beside a JSON file lies the same vocabulary as ranks. A path to ranks alone is a
    vocabulary without special tokens.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        base, suffix = os.path.splitext(path)
        with open(base + RANKS_SUFFIX, "rb") as lines:
            ranks = {base64.b64decode(t): int(i) for t, i in (line.split() for line in lines)}
        self.merges = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        special: list[str] = []
        if suffix != RANKS_SUFFIX:
            self.tokenizer = Tokenizer.from_file(path)
            special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        #: bytes of each id, for rules on the text of a token; none for special tokens
        self.strings = [b""] * (max(ranks.values()) + 1 + len(special))
        for token, i in ranks.items():
            self.strings[i] = token

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        if self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.merges.encode_to_numpy(text, disallowed_special=())


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
