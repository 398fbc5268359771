"""Tokenizing inside tasks: ids of whole texts, as packed integers.

The vocabulary file is named by the caller and read once per Python worker.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable
from functools import lru_cache
from itertools import compress
from operator import not_
from unicodedata import is_normalized

import numpy as np
import regex

# Words remembered per worker; the memory is emptied when it is full.
REMEMBERED = 1_000_000
# Stretches that are encoded in one go.
TOGETHER = 4096
# A word with marks at its end, or with a line feed before it.
WORD_AND_MARKS = re.compile("(\n?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([!-&(-/:-@[-`{-~]*)")
# What is outside may be treated differently by two engines' character tables.
UNUSUAL = regex.compile(r"[^\t\n\r\x20-\x7e\xa1-\u024f]")
# Between two such characters a single blank starts a piece in byte-level cutting, and a single
# line feed is one. The pattern begins with the blank, so that only blanks are looked at.
VISIBLE = "!-~\xa1-\xac\xae-\u024f"
BETWEEN_PIECES = re.compile(f" (?<=[{VISIBLE}] )(?=[{VISIBLE}])")
BOUNDED = re.compile(f"\n?[{VISIBLE}](?:.*[{VISIBLE}])?", re.DOTALL)
BOUNDED_END = re.compile(f"(?:.*[{VISIBLE}])?", re.DOTALL)
# How byte-level cutting goes on within a stretch.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_alphabet() -> dict[int, int]:
    """The letter that byte-level merging uses for each byte.

    Printable bytes stand for themselves, the others for letters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: 256 + n for n, byte in enumerate(others)}


ALPHABET = _byte_alphabet()
# The same as a table. The zero byte stays, to stand between pieces.
LETTERS = np.array([ALPHABET.get(byte, byte) for byte in range(256)], "<u4")
LETTERS[0] = 0


class Tokenizer:
    """A tokenizer file, with ids as little-endian unsigned 32-bit integers in bytes.

    Where the file says that a text is folded to lower case, cut by a pattern and merged
    byte by byte, no merge reaches over white space, so what lies between is looked up.
    Any other file, and any text with unusual characters or something like a special
    token, is encoded whole.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer as File

        self.file = File.from_file(path)
        self.file.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.pattern = self._word_pattern(layout)
        self.stretches = self._cut_at_blanks(layout)
        self.mark = next((t for t in layout["added_tokens"] if t["special"] and not t["normalized"]), None)
        self.merge = self.file.model.tokenize
        if self.stretches:
            # What is merged here is remembered here, so a model that remembers nothing is faster.
            merging = File.from_file(path).model
            merging._resize_cache(0)
            self.merge = merging.tokenize
        self.known: dict[str, bytes] = {}
        # Stretches of texts with other white space than single blanks and line feeds.
        self.spaced: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}

    @staticmethod
    def _cut_at_blanks(layout: dict) -> bool:
        cutting = layout["pre_tokenizer"] or {}
        return (
            not layout["normalizer"]
            and cutting.get("type") == "ByteLevel"
            and not cutting["add_prefix_space"]
            and cutting["use_regex"]
            and not any(" " in t["content"] or "\n" in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in layout["added_tokens"])
        )

    @staticmethod
    def _word_pattern(layout: dict):
        folding = [step["type"] for step in (layout["normalizer"] or {}).get("normalizers", [])]
        cutting = (layout["pre_tokenizer"] or {}).get("pretokenizers", [])
        if folding != ["NFC", "Replace", "Lowercase"] or len(cutting) != 2:
            return None
        split, letters = cutting
        if split["type"] != "Split" or not split["invert"] or split["behavior"] != "Removed":
            return None
        if letters["type"] != "ByteLevel" or letters["add_prefix_space"] or letters["use_regex"]:
            return None
        return regex.compile(split["pattern"]["Regex"])

    def _packed(self, texts: list[str]) -> list[bytes]:
        encoded = self.file.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]

    def _word(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            ids = [token.id for token in self.merge(word)]
            return struct.pack(f"<{len(ids)}I", *ids)
        # Mostly a word with a mark at its end; such pieces are known by themselves.
        pieces = self.pattern.findall(word)
        return b"".join([self._piece(p) for p in pieces])

    def _piece(self, piece: str) -> bytes:
        known = self.known.get(piece)
        if known is None:
            letters = piece.encode().decode("latin-1").translate(ALPHABET)
            ids = [token.id for token in self.merge(letters)]
            known = self.known[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without unusual characters, each merged by itself."""
        if not pieces:
            return []
        letters = LETTERS[np.frombuffer("\0".join(pieces).encode(), np.uint8)]
        merge, pack = self.merge, struct.pack
        found = ([token.id for token in merge(piece)] for piece in letters.tobytes().decode("utf-32-le").split("\0"))
        return [pack(f"<{len(ids)}I", *ids) for ids in found]

    def _learn(self, stretches: Iterable[str], known: dict[str, bytes], any_bounds: bool) -> set[str]:
        """Remember stretches, cut into pieces that are merged one by one.

        Returns those whose ends may belong to pieces that go on, unless they may have any.
        """
        special = self.mark["content"] if self.mark else None
        words, marked, others, whole, unbounded = set(), [], [], [], set()
        for stretch in stretches:
            if stretch.isascii() and stretch.isalpha():
                words.add(stretch)
            elif special and special in stretch:
                whole.append(stretch)
            elif match := WORD_AND_MARKS.fullmatch(stretch):
                marked.append((stretch, *match.groups()))
            elif not any_bounds and not BOUNDED.fullmatch(stretch):
                unbounded.add(stretch)
            elif UNUSUAL.search(stretch):
                whole.append(stretch)
            else:
                others.append((stretch, PIECES.findall(self._with_blank(stretch))))
        words.update(word for _, feed, word, _ in marked if not feed and word not in known)
        known.update(zip(words, self._merged([" " + word for word in words])))

        pieces, parts = self.pieces, {"\n"}
        for _, feed, word, marks in marked:
            parts.update((word, marks) if feed else (marks,))
        for _, cut in others:
            parts.update(cut)
        new = [part for part in parts if part not in pieces]
        pieces.update(zip(new, self._merged(new)))
        for stretch, feed, word, marks in marked:
            known[stretch] = (pieces[feed] + pieces[word] if feed else known[word]) + pieces[marks]
        for stretch, cut in others:
            known[stretch] = b"".join([pieces[part] for part in cut])
        for at in range(0, len(whole), TOGETHER):
            self._learn_whole(whole[at : at + TOGETHER], known)
        return unbounded

    @staticmethod
    def _with_blank(stretch: str) -> str:
        return stretch if stretch.startswith("\n") else " " + stretch

    def _learn_whole(self, stretches: list[str], known: dict[str, bytes]) -> None:
        """Remember stretches, encoded in one go with a special token between them."""
        mark = self.mark["content"] if self.mark and not self.file.encode_special_tokens else None
        if mark is None or any(mark in x for x in stretches):
            known.update(zip(stretches, self._packed(list(map(self._with_blank, stretches)))))
            return
        (packed,) = self._packed([mark.join(map(self._with_blank, stretches))])
        ids = np.frombuffer(packed, "<u4")
        ends = np.append(np.flatnonzero(ids == self.mark["id"]), len(ids)).tolist()
        begin = 0
        for stretch, end in zip(stretches, ends, strict=True):
            known[stretch] = packed[4 * begin : 4 * end]
            begin = end + 1

    def _by_stretches(self, texts: list[str]) -> list[bytes]:
        """Texts as stretches, of which all but the first of a text begin with a blank or,
        as it is written then, a line feed. Texts with other white space are cut at less."""
        if max(len(self.known), len(self.spaced), len(self.pieces)) > REMEMBERED:
            self.known.clear()
            self.spaced.clear()
            self.pieces = {"": b""}
        cut = [text.replace("\n", " \n").split(" ") for text in texts]
        starts = [stretches.pop(0) for stretches in cut]
        found, unbounded = self._look_up(cut, self.known, any_bounds=False)
        again = [
            i
            for i, (start, rest) in enumerate(zip(starts, cut))
            if not BOUNDED_END.fullmatch(start) or (unbounded and not unbounded.isdisjoint(rest))
        ]
        for i in again:
            starts[i], *cut[i] = BETWEEN_PIECES.split(texts[i])
        less_cut, _ = self._look_up([cut[i] for i in again], self.spaced, any_bounds=True)
        for i, ids in zip(again, less_cut):
            found[i] = ids
        return [start + b"".join(ids) for start, ids in zip(self._packed(starts), found)]

    def _look_up(
        self, cut: list[list[str]], known: dict[str, bytes], any_bounds: bool
    ) -> tuple[list[list[bytes]], set[str]]:
        """Ids of each stretch, none for those that ``_learn`` returns, and these."""
        found = [list(map(known.get, stretches)) for stretches in cut]
        missing = set()
        for stretches, ids in zip(cut, found):
            missing.update(compress(stretches, map(not_, ids)))
        unbounded = self._learn(missing, known, any_bounds)
        return [
            [known.get(stretch, b"") if ids is None else ids for stretch, ids in zip(stretches, each)]
            for stretches, each in zip(cut, found)
        ], unbounded

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.stretches:
            return self._by_stretches(texts)
        found: list[bytes] = [b""] * len(texts)
        whole = []
        for i, text in enumerate(texts):
            if (
                self.pattern is None
                or "<|" in text
                or UNUSUAL.search(text)
                or not is_normalized("NFC", text)
            ):
                whole.append(i)
                continue
            words = text.lower().split()
            if len(self.known) > REMEMBERED:
                self.known.clear()
            known = self.known
            for word in set(words).difference(known):
                known[word] = self._word(word)
            found[i] = b"".join(map(known.__getitem__, words))
        for i, ids in zip(whole, self._packed([texts[i] for i in whole])):
            found[i] = ids
        return found


@lru_cache(maxsize=2)
def tokenizer(path: str, special_as_text: bool = False) -> Tokenizer:
    return Tokenizer(path, special_as_text)


def narrow(ids: bytes, width: int) -> bytes:
    """Ids of four bytes in ``width`` bytes; raises if one of them does not fit."""
    values = np.frombuffer(ids, "<u4")
    if width < 4 and len(values) and int(values.max()) >= 1 << (8 * width):
        raise ValueError(f"Id {int(values.max())} does not fit in {width} bytes")
    return values.astype(f"<u{width}").tobytes()
