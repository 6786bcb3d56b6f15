"""Token ids of whole texts from a public tokenizer file.

The library's merge loop is slow, while words recur.  A text is cut only where the
tokenizer itself always cuts; the pieces of a slice of texts are numbered in Arrow,
each distinct one is looked up among the known ones or encoded, and the ids of a text
are gathered from those of its pieces.  ``tests/llm/test_tokens.py`` holds this against
encoding whole texts.

Known pieces take a bounded amount of memory in a worker (``KNOWN_BYTES``): they are
kept in two generations.  What is looked up moves to the younger one; when that is
full, it becomes the older one and the former older one goes, so frequent pieces stay.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Memory that the known pieces of a worker process may take.
KNOWN_BYTES = 192 << 20
# What a piece takes besides its characters and ids: two objects and a table entry.
PIECE_BYTES = 190
# Pieces encoded at a time.
BATCH = 20_000
# Words whose ids are gathered at a time.
GATHER = 50_000

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
# A letter and punctuation after it: vocabularies that drop white space cut there, but
# not always before an apostrophe.  Latin-1 letters only: they stay letters, each of
# its own, when lower-cased.
_MARK = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"


class Known:
    """Pieces and their ids, in two generations of bounded size."""

    def __init__(self, most: int = KNOWN_BYTES):
        self.most = most // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def look_up(self, pieces: list[str], learn: Callable[[list[str]], list[bytes]]
                ) -> list[bytes]:
        """The ids of each piece (all different); ``learn`` gives those of new ones."""
        out = list(map(self.young.get, pieces))
        missed = [i for i, ids in enumerate(out) if ids is None]
        if not missed:
            return out
        names = [pieces[i] for i in missed]
        found = list(map(self.old.get, names))
        new = [k for k, ids in enumerate(found) if ids is None]
        for at in range(0, len(new), BATCH):
            part = new[at:at + BATCH]
            for k, ids in zip(part, learn([names[k] for k in part]), strict=True):
                found[k] = ids
        for i, ids in zip(missed, found, strict=True):
            out[i] = ids
        self.held += PIECE_BYTES * len(names) + sum(map(len, names)) + sum(map(len, found))
        self.young.update(zip(names, found, strict=True))
        if self.held > self.most:
            self.old, self.young, self.held = self.young, {}, 0
        return out


class PieceEncoder:
    """Encodes texts as little-endian unsigned 32-bit ids.

    ``cut`` names where a text may be cut: ``"space"`` for byte-level
    vocabularies that keep one leading blank with a word, ``"drop"`` for
    vocabularies that drop white space and case.
    """

    def __init__(self, path: str, cut: str, known_bytes: int = KNOWN_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if cut not in ("space", "drop"):
            raise ValueError(f"unknown cut {cut!r}")
        self.tokenizer = Tokenizer.from_file(path)
        # the strings of special tokens in a text are ordinary text
        self.tokenizer.encode_special_tokens = True
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # every piece comes once: it only costs
        self.keep_space = cut == "space"
        self.known = Known(known_bytes)
        # bytes that each id of a byte-level vocabulary stands for
        vocabulary = self.tokenizer.get_vocab()
        end = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, "i8")
        for token, i in vocabulary.items():
            self.id_bytes[i] = len(token.removesuffix(end))

    def _blanks(self, text: str) -> str | None:
        """``text`` with a blank between its pieces; None if it has to be cut one by
        one.  A piece that starts with a blank is given without it, any other with a
        line break in front."""
        if not self.keep_space:
            return text.replace("\n", " ")
        if text and " ".join(text.split()) == text.replace("\n", " "):
            return "\n" + text.replace("\n", " \n\n")
        return None

    def _raw(self, piece: str) -> str:
        if not self.keep_space:
            return piece
        return piece[1:] if piece[:1] == "\n" else " " + piece

    def _encode(self, new: list[str]) -> list[bytes]:
        """The ids of each piece, encoded on its own."""
        found = self.tokenizer.encode([self._raw(p) for p in new], is_pretokenized=True,
                                      add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        return _split(ids, np.searchsorted(np.array(found.word_ids, "i8"),
                                           np.arange(1, len(new) + 1)))

    def _sizes(self, words: list[str]) -> list[int] | None:
        """Bytes of each word that its ids stand for; None if that cannot be told."""
        if self.keep_space:
            return [1 + len(w.encode()) for w in words]
        text = " ".join(words)
        if not text.isascii() and self.tokenizer.normalizer is not None:
            words = self.tokenizer.normalizer.normalize_str(text).split(" ")
            if len(words) != text.count(" ") + 1:
                return None
        return [len(w.encode()) for w in words]

    def _encode_words(self, words: list[str]) -> list[bytes] | None:
        """The same for words without white space in them, as one text: the tokenizer
        cuts before each blank.  None if the ids do not fit the words."""
        text = " " + " ".join(words)
        sizes = self._sizes(words)
        if sizes is None:
            return None
        ids = np.array(self.tokenizer.encode_batch_fast(
            [text], add_special_tokens=False)[0].ids, "<u4")
        covered = np.cumsum(self.id_bytes[ids])
        ends = np.cumsum(sizes)
        at = np.searchsorted(covered, ends)
        if len(ids) and at[-1] == len(ids) - 1 and np.array_equal(covered[at], ends):
            return _split(ids, at + 1)
        return None

    def _learn(self, new: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(new)
        plain = [i for i, p in enumerate(new) if p.split() == [p]]
        if plain:
            found = self._encode_words([new[i] for i in plain])
            for i, ids in zip(plain, found or (), strict=False):
                out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        if rest:
            for i, ids in zip(rest, self._encode([new[i] for i in rest]), strict=True):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        spaced = [self._blanks(t) for t in texts]
        whole = [i for i, s in enumerate(spaced) if s is not None]
        odd = [i for i, s in enumerate(spaced) if s is None]
        lines = pa.array([spaced[i] for i in whole], pa.large_string())
        if not self.keep_space:
            lines = pc.replace_substring_regex(lines, _MARK, r"\1 \2")
        lists = pc.split_pattern(lines, " ")
        cut = [["\n" + p for p in _CUT.split(texts[i]) if p] for i in odd]
        words = pa.concat_arrays([lists.flatten(), pa.array([p for c in cut for p in c],
                                                            pa.large_string())])
        counts = np.zeros(len(texts), "i8")
        counts[whole] = np.diff(lists.offsets.to_numpy())
        counts[odd] = [len(c) for c in cut]
        del spaced, lines, lists, cut
        numbered = words.dictionary_encode()
        place, names = numbered.indices.to_numpy(), numbered.dictionary
        del words, numbered
        if not self.keep_space:  # other letters may join marks that follow them
            folded = pc.if_else(pc.string_is_ascii(names), pc.ascii_lower(names),
                                names).dictionary_encode()
            place, names = folded.indices.to_numpy()[place], folded.dictionary
        blobs = self.known.look_up(names.to_pylist(), self._learn)
        size = np.fromiter(map(len, blobs), "i8", len(blobs)) // 4
        ids = np.frombuffer(b"".join(blobs), "<u4")
        first = np.cumsum(size) - size
        # words of a text stand together: those of whole texts, then those cut one by one
        order = np.array([*whole, *odd], "i8")
        out: list[bytes] = [b""] * len(texts)
        ends = np.concatenate([[0], np.cumsum(counts[order])])
        k = 0
        while k < len(order):  # texts of some GATHER words at a time
            stop = max(int(np.searchsorted(ends, ends[k] + GATHER, "right")) - 1, k + 1)
            own = place[ends[k]:ends[stop]]
            reach = np.cumsum(size[own])
            raw = b""
            if len(own):
                raw = ids[np.repeat(first[own] - reach + size[own], size[own])
                          + np.arange(reach[-1])].tobytes()
            cuts = np.concatenate([[0], 4 * reach])[ends[k:stop + 1] - ends[k]].tolist()
            for i, a, b in zip(order[k:stop].tolist(), cuts, cuts[1:], strict=False):
                out[i] = raw[a:b]
            k = stop
        return out


def _split(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
    return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str, cut: str, known_bytes: int = KNOWN_BYTES) -> PieceEncoder:
    """The worker process's encoder for this vocabulary; the last one asked for is kept."""
    key = (path, cut, known_bytes)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(path, cut, known_bytes)
    return _ENCODERS[key]
