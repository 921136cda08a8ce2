"""Byte-level BPE of whole texts through a cache of their space-separated spans.

A pre-token never crosses the place before a space that a non-space follows, so a text is the sum of
its spans: the stretches cut there.  Spans repeat; each worker encodes one only when it is new, many
new ones in one call.  Texts outside the plain alphabet go to the library as they are.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections.abc import Iterable

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The pre-token pattern of the vocabulary.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters for which both libraries and this module agree on what is a letter, digit or space.
_ODD = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]")
# Longer spans are left to the library, whose merging does not slow down on them.
LONG_SPAN = 512
# Characters of spans one worker keeps before it starts afresh.
KEPT_CHARS = 6_000_000


def _alphabet() -> dict[str, int]:
    """The vocabulary file writes bytes as printable characters; this reads them back."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Slots(dict):
    """Span to slot number; a new span gets the next slot and waits in ``new``."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.size = 0

    def __missing__(self, span: str) -> int:
        slot = self[span] = self.size
        self.size += 1
        self.new.append(span)
        return slot


class Codec:
    """Encodes whole texts exactly as ``tokenizers`` does with special strings at their default."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        with open(vocabulary, encoding="utf-8") as file:
            described = json.load(file)
        special = [t["content"] for t in described["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        alphabet = _alphabet()
        ranks = {
            bytes(alphabet[c] for c in token): number
            for token, number in described["model"]["vocab"].items()
            if token not in special
        }
        self.fast = tiktoken.Encoding(
            "spans", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}
        )
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            self.widths[number] = len(token)
        self.forget()

    def forget(self) -> None:
        self.slots = _Slots()
        self.values: list[bytes] = []
        self.lengths = np.zeros(1 << 16, np.int64)
        self.chars = 0
        self.loaded = ""

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _first(self, text: str) -> bytes:
        if len(text) > LONG_SPAN:
            return self._whole(text)
        return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()

    def plain(self, text: str) -> bool:
        """Whether the text is the sum of its spans and of the plain alphabet."""
        return not (
            "  " in text
            or " \n" in text
            or " \t" in text
            or " \r" in text
            or _ODD.search(text)
            or (self.special and self.special.search(text))
        )

    def _encode_spans(self, spans: list[str]) -> list[bytes]:
        """Ids of every span with the space before it, all in one call."""
        ids = np.array(self.fast.encode_ordinary("".join([" " + s for s in spans])), dtype="<u4")
        ends = np.cumsum([len(s.encode()) + 1 for s in spans])
        cuts = [0, *(4 * (np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1)).tolist()]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _learn(self, keep_ids: bool) -> None:
        """Fills the slots of new spans."""
        new, self.slots.new = self.slots.new, []
        if not new:
            return
        first = self.slots.size - len(new)
        if self.slots.size > len(self.lengths):
            self.lengths = np.resize(self.lengths, 2 * self.slots.size)
        # A span that starts with a white space or is empty reads differently beside others.
        alone = [i for i, s in enumerate(new) if not s or len(s) > LONG_SPAN]
        found: list[bytes | None] = [None] * len(new)
        for i in alone:
            found[i] = self._whole(" " + new[i])
        together = [i for i, value in enumerate(found) if value is None]
        if together:
            for i, value in zip(together, self._encode_spans([new[i] for i in together]), strict=True):
                found[i] = value
        self.lengths[first : self.slots.size] = [len(v) // 4 for v in found]
        if keep_ids:
            self.values.extend(found)
        self.chars += sum(map(len, new)) + 16 * len(new)

    def preload(self, spans: list[str], lengths: np.ndarray, name: str) -> None:
        """Starts the counting cache with known spans; ``name`` tells which table they are from."""
        self.forget()
        self.loaded = name
        for span in spans:
            self.slots[span]
        self.slots.new = []
        self.lengths = np.resize(self.lengths, max(len(self.lengths), 2 * self.slots.size))
        self.lengths[: self.slots.size] = lengths

    def count(self, texts: Iterable[str | None]) -> list[int]:
        """Number of tokens of every text; null counts as empty."""
        get, rows = self.slots.__getitem__, []
        for text in texts:
            if not text:
                rows.append(0)
            elif self.plain(text):
                head, *spans = text.split(" ")
                rows.append((len(self._first(head)) // 4, np.fromiter(map(get, spans), np.int64, len(spans))))
            else:
                rows.append(len(self._whole(text)) // 4)
        self._learn(False)
        return [r if isinstance(r, int) else r[0] + int(self.lengths[r[1]].sum()) for r in rows]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit numbers; null counts as empty."""
        if self.chars > KEPT_CHARS:
            self.forget()
        get, rows = self.slots.__getitem__, []
        for text in texts:
            if not text:
                rows.append(b"")
            elif self.plain(text):
                head, *spans = text.split(" ")
                rows.append((self._first(head), list(map(get, spans))))
            else:
                rows.append(self._whole(text))
        self._learn(True)
        value = self.values.__getitem__
        return [r if isinstance(r, bytes) else r[0] + b"".join(map(value, r[1])) for r in rows]
