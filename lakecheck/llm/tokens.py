"""Token ids of a public byte-level BPE vocabulary file (tokenizers JSON).

Where the file's ids are the order of its merges - a fixed property of this family of vocabularies that is
checked when the file is read - the ids are made by tiktoken, which gives the same ids several times faster.
Otherwise, and for texts with a special token's string or that tiktoken refuses, the tokenizers library
encodes.
"""

from __future__ import annotations

import functools
import json

import numpy as np

VOCABULARY = "byte_bpe_50k.json"


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    return out


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        vocab, merges, chars = spec["model"]["vocab"], spec["model"]["merges"], _byte_chars()
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        ordered = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))
        level = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not spec["pre_tokenizer"].get("add_prefix_space") and not spec.get("normalizer")
        self.fast = None
        if ordered and level:
            ranks = {bytes(chars[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _fast(self, text: str) -> np.ndarray | None:
        """tiktoken's ids; None where it refuses the text, as it does with very long runs of blanks."""
        try:
            return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
        except BaseException as e:  # tiktoken's Rust panics are not Exceptions
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return None

    def ids(self, text: str) -> np.ndarray:
        got = self._fast(text) if self.fast is not None and not any(s in text for s in self.special) else None
        return got if got is not None else np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def plain_ids(self, text: str) -> np.ndarray:
        """As ``ids``, but a special token's string is ordinary text."""
        got = self._fast(text) if self.fast is not None else None
        if got is not None:
            return got
        self.slow.encode_special_tokens = True
        try:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        finally:
            self.slow.encode_special_tokens = False


@functools.cache
def encoder(path: str | None = None) -> Encoder:
    """The encoder of a vocabulary file, read once per worker."""
    if path is None:
        from public_tokenizers import path as place
        path = place(VOCABULARY)
    return Encoder(path)
