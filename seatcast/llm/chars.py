"""Character trigrams over a closed alphabet, and noisy-channel restoring of
obfuscated words."""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np

# The alphabet: a to z, the letters from U+00DF to U+00FF but for the division
# sign, and 0 for everything else.  64 symbols bound every table by 64**3.
SYMBOLS = 64
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(
    chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
TRIGRAMS = SYMBOLS ** 3

_INDEX = {c: i + 1 for i, c in enumerate(LETTERS)}
_TABLE = np.zeros(0x250, "i4")
for _c, _i in _INDEX.items():
    _TABLE[ord(_c)] = _i


def codes(text: str) -> np.ndarray:
    """Trigram codes of a text, lower-cased; other characters are one symbol,
    and the text is framed by it."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    s = np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], 0)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)  # runs of others count once
    s = s[keep]
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


def log_model(counts: np.ndarray, smoothing: float = 0.5) -> np.ndarray:
    """Log probability of the third symbol after the first two, backed off to
    the pair by mixing; shape 64 x 64 x 64, single precision."""
    c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype("f8")
    pair = c.sum(axis=0) + smoothing
    pair /= pair.sum(axis=1, keepdims=True)
    weight = 5.0
    p = (c + weight * pair[None]) / (c.sum(axis=2, keepdims=True) + weight)
    return np.log(p).astype("f4")


# What a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t",
        "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c",
        "€": "e", "¡": "i"}
# Log cost of writing a letter as something else, of writing it again and
# again, and of putting a separator between letters.
SUBSTITUTED, REPEATED, SEPARATED = -1.0, -0.7, -0.2

_EDGE = "\"'`.,;:?!()[]{}<>*%#&$|=~^-_/\\"
_NOISE = re.compile(r"([*%#&$!|=~_-])\1+$")
_SEPARATOR = re.compile(r"(?<=[^\W_])[.*_~·-](?=[^\W_])")
_LEET_SET = re.escape("".join(LEET))
_MAY = re.compile(rf"[^\W\d_].*[{_LEET_SET}]|[{_LEET_SET}].*[^\W\d_]")
_LONG = re.compile(r"([^\W\d_])\1\1")
# What joins words to one token: all but letters, digits, marks and look-alikes.
_MARKS = "".join(c for c in map(chr, range(0x300, sys.maxunicode + 1))
                 if unicodedata.category(c)[0] == "M")
_JOINT = re.compile(rf"[^\w{_LEET_SET}{_MARKS}]+|_+")
# Look-alikes that may also stand between words.
_SIGNS = re.compile(rf"[{re.escape(''.join(c for c in LEET if not c.isdigit()))}]+")
# Longer tokens are not one disguised word, but the words they are made of.
LONG = 40
# Three or more single characters, a blank between each two.
SPACED = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")


class Restorer:
    """Restores single words with a character model and remembers them."""

    LIMIT = 500_000

    def __init__(self, model: np.ndarray):
        self.model = model
        self.known: dict[str, str] = {}
        self.known_parts: dict[str, tuple[str, ...]] = {}

    def viterbi(self, word: str) -> str:
        """The likeliest letters behind ``word``: a lattice with, per run of a
        character, its letter once or twice or the letters it may stand for."""
        steps: list[list[tuple[str, float]]] = []
        for m in re.finditer(r"(.)\1*", word):
            c, n = m[1], len(m[0])
            options: list[tuple[str, float]] = []
            if c in _INDEX:
                if n <= 2:
                    options.append((c * n, 0.0))
                else:
                    options += [(c, REPEATED), (c * 2, REPEATED)]
            elif c.isalpha():  # letters outside the alphabet stay
                options.append((c * min(n, 2), 0.0))
            for x in LEET.get(c, ""):
                options.append((x * min(n, 2), SUBSTITUTED * min(n, 2)))
                if n > 1:
                    options.append((x, SUBSTITUTED + REPEATED))
            if options:
                steps.append(options)
        # states are the last two symbols; a way is a link to its last letters
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in steps:
            new: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, way) in best.items():
                for letters, cost in options:
                    x, y, s = a, b, score + cost
                    for c in letters:
                        z = _INDEX.get(c, 0)
                        s += float(self.model[x, y, z])
                        x, y = y, z
                    if (x, y) not in new or s > new[x, y][0]:
                        new[x, y] = (s, (way, letters))
            best = new

        def spelled(way: tuple) -> str:
            out = []
            while way:
                way, letters = way
                out.append(letters)
            return "".join(reversed(out))

        return max((s + float(self.model[a, b, 0]), spelled(way))
                   for (a, b), (s, way) in best.items())[1]

    def word(self, token: str) -> str:
        """The word behind a lower-cased token without white space."""
        found = self.known.get(token)
        if found is None:
            if len(self.known) > self.LIMIT:
                self.known.clear()
            found = self.known[token] = self._word(token)
        return found

    def _word(self, token: str) -> str:
        if not token.isalpha():
            token = _NOISE.sub("", token).rstrip(_EDGE).lstrip(_EDGE.replace("$", "")
                                                               .replace("(", "").replace("|", ""))
        if token.isalpha():
            return self.viterbi(token) if _LONG.search(token) else token
        if _SEPARATOR.search(token):
            parts = _SEPARATOR.split(token)
            if all(len(p) == 1 for p in parts):
                return self.viterbi("".join(parts))
        if _MAY.search(token) and not token.isdigit():
            return self.viterbi(token)
        return re.sub(r"[\W\d_]+", "", token)

    def parts(self, token: str) -> tuple[str, ...]:
        """The words behind a lower-cased token without white space: the token
        as one word unless it is long, and the words that it joins."""
        found = self.known_parts.get(token)
        if found is None:
            if len(self.known_parts) > self.LIMIT:
                self.known_parts.clear()
            found = self.known_parts[token] = tuple(self._parts(token))
        return found

    def _parts(self, token: str) -> set[str]:
        if token.isalpha():
            return {self.word(token)}
        pieces, singles = [], ""
        for p in [*filter(None, _JOINT.split(token)), ""]:
            if len(p) == 1:  # single letters with separators are one word
                singles += p
                continue
            pieces += [singles, p]
            singles = ""
        if len(token) <= LONG:
            pieces.append(token)
        for p in list(pieces):
            pieces += (x for x in _SIGNS.split(p) if len(x) > 2 and x != p and x.isalpha())
        return {self.word(p) for p in pieces if p}

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text; letters with blanks between
        them are one word too."""
        low = text.lower()
        out: set[str] = set()
        for token in set(low.split()):
            out.update(self.parts(token))
        for m in SPACED.finditer(low):
            out.add(self.word(m[0].replace(" ", "")))
        out.discard("")
        return out


_RESTORERS: dict[int, Restorer] = {}


def restorer(key: int, model: np.ndarray) -> Restorer:
    """The worker process's restorer for the model that ``key`` stands for."""
    if key not in _RESTORERS:
        _RESTORERS.clear()
        _RESTORERS[key] = Restorer(model)
    return _RESTORERS[key]
