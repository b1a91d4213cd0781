"""Exact, fast use of the public tokenizers inside Arrow tasks.

The ``tokenizers`` and ``sentencepiece`` libraries define the ids.  Where a ``.json`` file is
plain byte-level BPE whose merges stand in the order of their ids, rank-based BPE over the same
vocabulary gives the same ids several times faster; ``RankEncoder`` builds it from the file
itself.  It takes only texts on which the two cannot differ: those without an added token's
string, with characters of long-settled Unicode classes, and without runs of white space so long that
its pretokens would exhaust the stack.  All others go to the library.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

#: Pretokens of byte-level BPE; a fixed value of the format.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin, Greek, Cyrillic, general punctuation and the euro sign: classes that no Unicode version changes.
_unsettled = re.compile("[^\u0000-ɏΑ-ΡΣ-ωЀ-џ‐-‧€]").search

#: The pretokens' look-ahead goes back step by step through a run of white space, on the stack.
LONG_RUN = 20_000
_long_run = re.compile(r"(?<!\s)\s{%d}" % LONG_RUN).search


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; a path is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


class LibraryEncoder:
    """Whole texts through the library that the file's ending names."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self._ids = lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [np.asarray(x, "<u4").tobytes() for x in self._ids(texts)] if texts else []


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def ranks_of(spec: dict) -> dict[bytes, int] | None:
    """Byte strings and ranks of a plain byte-level BPE file; None if it is something else."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") \
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    vocab, place = model["vocab"], -1
    for merge in model["merges"]:
        rank = vocab["".join(merge if isinstance(merge, list) else merge.split(" "))]
        if rank <= place:
            return None
        place = rank
    letters, added = byte_alphabet(), {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in added}


class RankEncoder(LibraryEncoder):
    """The same ids as ``LibraryEncoder`` by rank-based BPE."""

    def __init__(self, path: str, ranks: dict[bytes, int]):
        import tiktoken

        super().__init__(path)
        self.fast = tiktoken.Encoding("ranks", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _settled(self, text: str) -> bool:
        return (not any(a in text for a in self.added) and (text.isascii() or not _unsettled(text))
                and (len(text) < LONG_RUN or not _long_run(text)))

    def encode(self, texts: list[str]) -> list[bytes]:
        fast = [self._settled(t) for t in texts]
        slow = iter(super().encode([t for t, ok in zip(texts, fast) if not ok]))
        return [np.asarray(self.fast.encode_ordinary(t), "<u4").tobytes() if ok else next(slow) for t, ok in zip(texts, fast)]


@lru_cache(maxsize=4)
def encoder(name: str) -> LibraryEncoder:
    """The encoder of a tokenizer file, one per Python worker."""
    path = tokenizer_path(name)
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            ranks = ranks_of(json.load(f))
        if ranks:
            return RankEncoder(path, ranks)
    return LibraryEncoder(path)


def batches(texts: list[str], chars: int = 1 << 22):
    """Slices of at most about ``chars`` characters (one text at least), to bound memory."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))
