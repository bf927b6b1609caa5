"""Byte-level BPE ids of whole texts, looked up per piece of text."""

from __future__ import annotations

import base64
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from .batches import span_hashes

#: Pieces whose ids a worker remembers before it starts anew.
MEMORY = 400_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123)]] = True
#: White space beyond ASCII, and controls that some call white space: such texts are encoded whole.
_ODD_CODES = (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, *range(0x205F, 0x2065), 0x3000, 0xFEFF)
_ODD = re.compile(f"[{''.join(map(chr, _ODD_CODES))}]")


class Encoder:
    """Ids of texts as the tokenizer file gives them, special strings being ordinary text.

    A text is cut where its pre-tokens surely end (before a blank and a visible character, before a comma or
    full stop after an ASCII letter, around a single line break); each distinct piece of a batch is encoded
    once. ``ranks_path`` holds the vocabulary of ``json_path`` as ranks, which encodes single pieces faster.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        self.whole = Tokenizer.from_file(json_path)
        self.whole.encode_special_tokens = True
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.piece = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[bytes, np.ndarray] = {}

    def cuts(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Byte at which each piece starts; every text that is not empty starts one."""
        n = len(raw)
        if not n:
            return np.zeros(0, np.int64)
        filled = np.diff(at) > 0
        first, last = at[:-1][filled], at[1:][filled] - 1
        space = _SPACE[raw]
        before, before2 = np.append(True, space[:-1]), np.append([True, True], space[:-2])[:n]
        after = np.append(space[1:], True)
        after[last] = True
        before2[np.minimum(first + 1, n - 1)] = False  # nothing stands before the first byte of a text
        cut = (raw == 32) & ~after
        cut |= ((raw == 44) | (raw == 46)) & np.append(False, _ALPHA[raw[:-1]])
        cut |= (raw == 10) & ~before
        cut |= np.append(False, raw[:-1] == 10) & ~space & ~before2
        cut[first] = True
        return np.flatnonzero(cut)

    def ids(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts laid end to end, and the n + 1 offsets of the texts."""
        n = len(at) - 1
        own = raw.tobytes()
        odd = {}
        if _has_odd(raw):
            for t in range(n):
                text = own[at[t] : at[t + 1]].decode()
                if _ODD.search(text):
                    odd[t] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        starts = self.cuts(raw, at)
        ends = np.append(starts[1:], len(raw))
        _, pick, back = np.unique(span_hashes(raw, starts), return_index=True, return_inverse=True)
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        encode, got = self.piece.encode_ordinary, []
        for a, b in zip(starts[pick].tolist(), ends[pick].tolist()):
            piece = own[a:b]
            x = known.get(piece)
            if x is None:
                x = known[piece] = np.array(encode(piece.decode()), np.uint32).tobytes()
            got.append(x)
        flat = np.frombuffer(b"".join(got), np.uint32)
        size = np.array([len(x) for x in got], np.int64) >> 2
        begin = np.cumsum(size) - size
        n_ids = size[back]
        out_at = np.cumsum(n_ids) - n_ids
        ids = flat[np.repeat(begin[back] - out_at, n_ids) + np.arange(n_ids.sum())]
        of_text = np.concatenate([[0], np.cumsum(n_ids)])[np.searchsorted(starts, at)]
        if not odd:
            return ids, of_text
        parts = [odd.get(t, ids[of_text[t] : of_text[t + 1]]) for t in range(n)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _has_odd(raw: np.ndarray) -> bool:
    two = (raw[:-1] == 0xC2) & ((raw[1:] == 0x85) | (raw[1:] == 0xA0))
    return bool(two.any() or ((raw >= 0x1C) & (raw <= 0x1F)).any() or ((raw >= 0xE1) & (raw <= 0xEF)).any())
