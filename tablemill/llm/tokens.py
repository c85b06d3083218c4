"""Token ids of a public byte-level vocabulary."""

from __future__ import annotations

import json
import os
import re

import numpy as np

# The splitting pattern of the vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The blanks of the pattern (Unicode's White_Space, a fixed value), in runs that its matcher has trouble with.
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Text to little-endian 32-bit ids, the same as the tokenizer file gives.

    The merges run in ``tiktoken``, which takes a fraction of the time; texts that hold one of the file's
    special strings, and files whose ids do not follow the order of their merges, go to ``tokenizers``.
    With ``size`` only the first ids of the vocabulary are used: texts fall into shorter pieces, special
    strings are ordinary text, and a file must number its merges in order.
    """

    def __init__(self, path: str, size: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, names = model["vocab"], _byte_names()
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.plain = None
        if all(vocab.get(m) == 256 + i for i, m in enumerate(merged)):
            ranks = {bytes(names[c] for c in t): i for t, i in vocab.items() if t not in self.special and (size is None or i < size)}
            self.plain = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        if size is not None:
            if self.plain is None:
                raise ValueError(f"{path}: ids do not follow the order of the merges")
            self.special = []

    def __call__(self, text: str) -> bytes:
        if self.plain is None or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self._ids(text)
        return np.array(ids, dtype="<u4").tobytes()

    def _ids(self, text: str) -> list[int]:
        """The pattern tries a run of blanks at every length, too deep for very long ones: these are cut out here.

        All of a run but its last blank (which may belong to the next word) is one piece; at the end of the text the
        whole run is.
        """
        ids, at = [], 0
        for run in LONG_RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self.plain.encode_ordinary(text[at : run.start()])
            ids += self.plain._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self.plain.encode_ordinary(text[at:])
