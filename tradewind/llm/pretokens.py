"""Pre-tokens of byte-level BPE vocabularies, found for a whole batch of texts at once.

The rule is the public pattern: contractions; letters, numbers or other characters with at most one space before them;
white space, of which the last character before a word stays apart. Runs of one character class are found with numpy, and
each match of the pattern is a function of the runs next to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex

from tradewind.llm.text import Hasher

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def ranges() -> list[tuple[int, int, int]]:
    """(class, first, last) of the code points that are letters, numbers or white space; computed on the driver."""
    points = "".join(map(chr, [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]))
    found = []
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        found += [(kind, ord(m.group()[0]), ord(m.group()[-1])) for m in regex.finditer(pattern, points)]
    return found


def class_table(of: list[tuple[int, int, int]]) -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for kind, first, last in of:
        table[first : last + 1] = kind
    return table


class PreTokens:
    """``start`` and ``end`` (in the bytes of ``data``) of the pre-tokens of all texts; ``first`` as in Words."""

    def __init__(self, texts: pa.Array, table: np.ndarray):
        texts = pa.compute.fill_null(texts.cast(pa.large_binary()), b"")
        _, offsets, values = texts.buffers()
        offset = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        self.data = data[offset[0] : offset[-1]]
        self.offset = offset - offset[0]
        char_at = np.flatnonzero((self.data & 0xC0) != 0x80)
        points = np.frombuffer(self.data.tobytes().decode().encode("utf-32-le"), np.uint32)
        n = len(points)
        if not n:
            self.start = self.end = np.zeros(0, np.int64)
            self.first = np.zeros(len(self.offset), np.int64)
            return
        kind = table[points]
        text_start = np.zeros(n + 1, bool)
        text_start[np.searchsorted(char_at, self.offset)] = True
        run = text_start[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        begin = np.flatnonzero(run)
        stop = np.append(begin[1:], n)
        of = kind[begin]
        token = run.copy()
        # white space before a word: its last character stands apart, and a plain space goes to the word
        spaces = (of == SPACE) & ~text_start[stop]
        last = stop[spaces] - 1
        token[last] = True
        plain = last[points[last] == 32]
        token[plain + 1] = False
        # contractions: an apostrophe alone between a character that is no plain space and letters
        mark = begin[(of == OTHER) & (stop - begin == 1) & (stop < n)]
        mark = mark[(points[mark] == 39) & token[mark] & ~text_start[mark + 1]]
        if len(mark):
            one = points[mark + 1]
            two = np.where(mark + 2 < n, points[np.minimum(mark + 2, n - 1)], 0)
            two[text_start[mark + 2]] = 0
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.zeros(len(mark), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (one == ord(a)) & (two == ord(b))
            for at, width in ((mark[short], 2), (mark[long], 3)):
                token[at + 1] = False
                rest = at + width
                rest = rest[rest < n]
                token[rest] = True
        starts = char_at[token]
        self.start = starts
        self.end = np.append(starts[1:], len(self.data))
        self.first = np.searchsorted(starts, self.offset)

    def __len__(self) -> int:
        return len(self.start)

    def distinct(self, hasher: Hasher) -> tuple[list[bytes], np.ndarray]:
        """The distinct pre-tokens, and for each pre-token the number of its value."""
        _, at, number = np.unique(hasher(self.data, self.start, self.end), return_index=True, return_inverse=True)
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start[at].tolist(), self.end[at].tolist())], number
