"""Style measures of a text, shared by the quality rules and the quality classifier."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

NAMES = (
    "log_words", "word_len", "symbols_per_word", "dup_line_share", "repeat_word_share", "adjacent_share", "distinct_share", "upper_share",
    "bang_per_word", "pipe_per_word", "words_per_line", "ended_lines", "comma_per_word", "digit_share", "top_word_share",
)
_SYMBOLS, _SPACE, _DIGITS = (np.frombuffer(x, dtype=np.uint8) for x in (b"#*$%&|<>", b" \t\n\x0b\x0c\r", b"0123456789"))


class Measured:
    """Counts of one text. Null is a text without words."""

    def __init__(self, text: str | None):
        text = text or ""
        raw = text.encode()
        self.words = words = raw.split()
        self.n = n = len(words)
        self.of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
        self.word_chars = len(text) - int(self.of[_SPACE].sum())
        self.n_symbols = int(self.of[_SYMBOLS].sum())
        self.lines = [x for x in text.split("\n") if x and not _blank(x)]
        self.n_dup_lines = len(self.lines) - len(set(self.lines))
        self.n_repeat_words = self._repeats() if n > 3 else 0

    def _repeats(self) -> int:
        """Words in windows of three that occur twice or more."""
        windows = list(zip(self.words, self.words[1:], self.words[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        counts = Counter(windows)
        out = end = 0
        for i, w in enumerate(windows):
            if counts[w] > 1:
                out += i + 3 - max(end, i)
                end = i + 3
        return out

    def values(self) -> list[float]:
        """The values of NAMES; all 0 without words."""
        n = self.n
        if not n:
            return [0.0] * len(NAMES)
        of, lines, words = self.of, max(1, len(self.lines)), Counter(self.words)
        upper, lower = int(of[65:91].sum()), int(of[97:123].sum())
        return [
            math.log1p(n), self.word_chars / n, self.n_symbols / n, self.n_dup_lines / lines, self.n_repeat_words / n,
            sum(map(bytes.__eq__, self.words, self.words[1:])) / n, len(words) / n, upper / max(1, upper + lower),
            int(of[33]) / n, int(of[124]) / n, math.log1p(n / lines), sum(x.endswith((".", "!", "?", "…")) for x in self.lines) / lines,
            int(of[44]) / n, int(of[_DIGITS].sum()) / max(1, self.word_chars), max(words.values()) / n,
        ]


def _blank(line: str) -> bool:
    return not line.strip(" \t\x0b\x0c\r")
