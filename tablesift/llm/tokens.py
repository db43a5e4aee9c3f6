"""Token ids of a byte-level BPE tokenizer file.

The file is one of the ``tokenizers`` library (vocabulary and merges in
JSON).  Its ids are computed by ``tiktoken`` from the same vocabulary, which
gives the same ids several times faster; that holds for a plain byte-level
BPE whose merges are in the order of their ids, and is tested against
``tokenizers``.  Texts that spell a special token of the file, and files of
any other kind, go to ``tokenizers`` itself.  A worker loads a file once.
"""

from __future__ import annotations

import json
import os

import numpy as np

# Fixed by byte-level BPE: the pattern that cuts a text into pre-tokens.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    """Path of the byte-level BPE file the queries use."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self._fast(spec)

    def _fast(self, spec: dict):
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        if not plain or spec.get("normalizer") or model["type"] != "BPE" or model.get("byte_fallback"):
            return None
        import tiktoken

        to_byte = _byte_of_char()
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.special}
        ids = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if ids != sorted(ids):
            return None
        ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit numbers; a null text has none."""
        if not text:
            return np.empty(0, dtype="<u4")
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    def count(self, text: str | None) -> int:
        return len(self.ids(text))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
