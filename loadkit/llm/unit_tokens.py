"""Token ids of whole texts, one distinct unit at a time.

A unit is a run of characters that the tokenizer treats alone: a word between
ASCII white space, with the white space before it where that matters. Where the split
pattern of the tokenizer is known, a plain word (printable ASCII without `'` and `<`, and the letters from U+00C0 to
U+00FF) is cut further, into its runs of letters, digits and signs, and lower-cased if the tokenizer does so. Each
distinct unit of a batch is tokenized once and remembered; the ids of the texts
are then gathered with numpy. Texts for which units are not independent (other
white space beside ASCII white space) are tokenized whole.

Plain units are words of the split pattern as they are, so many of them go through the library's model in one
call, and the bytes that each id stands for tell whose it is.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from loadkit.llm import textarrays as X

#: Lead bytes in UTF-8 of the white space beyond ASCII (U+0085 and U+00A0, U+1680, U+2000 to U+205F, U+3000): fixed values.
LEADS = (0xC2, 0xE1, 0xE2, 0xE3)
#: Unicode's white space beyond ASCII.
OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


_LEAD = np.zeros(256, np.int64)
_LEAD[list(LEADS)] = 1

#: Kinds of bytes: white space, letters, digits, signs, and those of words that are not cut.
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[list(b"0123456789")] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
# The letters from U+00C0 on: C3 and a second byte. All other lead bytes are odd, and so are the second bytes of the two signs among them.
_KIND[[0xC3, *range(0x80, 0xC0)]] = _LETTER
_KIND[[0x97, 0xB7]] = _ODD
_KIND[X.SPACE] = _SPACE
_KIND[list(b"'<")] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOWER[0x80:0x9F] += 32
_SIGNS = rb"[!-&(-/:;=-@\[-`{-~]+"
#: The split pattern of vocabularies with word ends.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Plain units, by whether white space has ids: one word of the split pattern each.
PLAIN = {False: re.compile(rb"[a-z\xc3\x9f-\xb6\xb8-\xbf]+|[0-9]|" + _SIGNS), True: re.compile(rb" ?(?:[A-Za-z\xc3\x80-\x96\x98-\xb6\xb8-\xbf]+|[0-9]+|" + _SIGNS + rb")")}


def known_split(tokenizer_json: str) -> bool:
    """Whether plain words can be cut: the file has the normaliser and the split pattern that `PLAIN` is made for."""
    file = json.loads(tokenizer_json)
    normalizer, split, model = file.get("normalizer"), file.get("pre_tokenizer") or {}, file["model"]
    if any(not t.get("special") or t.get("normalized") or "<" not in t["content"] for t in file["added_tokens"]) or model["type"] != "BPE" or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")):
        return False
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
    if normalizer is None:
        return not model.get("end_of_word_suffix") and split == level | {"use_regex": True}
    lowered = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    words = {"type": "Split", "pattern": {"Regex": WORD_SPLIT}, "behavior": "Removed", "invert": True}
    return (normalizer == {"type": "Sequence", "normalizers": lowered} and model.get("end_of_word_suffix") == "</w>"
            and split == {"type": "Sequence", "pretokenizers": [words, level | {"use_regex": False}]})


def plain_cuts(data: np.ndarray, words: X.Words, digits_alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places inside plain words where the kind of byte changes, or before each digit; and which bytes are in a plain word."""
    kind = _KIND[data]
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kind == _ODD, out=odd[1:])
    plain = odd[words.end] == odd[words.start]
    step = np.zeros(len(data) + 1, np.int8)
    step[words.start[plain]] = 1
    step[words.end[plain]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    new = np.zeros(len(data), bool)
    if len(data):
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) if digits_alone else kind[1:] != kind[:-1]
    new &= inside
    new[words.start] = False
    return np.flatnonzero(new), inside


class Memo:
    """Ids of units, in two generations of at most `most` units, so that memory is bounded."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], most: int = 100_000):
        self.encode, self.most, self.young, self.old = encode, most, {}, {}

    def get(self, units: list[bytes]) -> list[bytes]:
        """Ids of each unit as bytes of 16-bit integers."""
        young, old = self.young, self.old
        found = [young.get(u) for u in units]
        lost = [i for i, f in enumerate(found) if f is None]
        if lost:
            new = []
            for i in lost:
                found[i] = old.get(units[i])
                if found[i] is None:
                    new.append(i)
            for at in range(0, len(new), 20_000):
                some = new[at:at + 20_000]
                for i, ids in zip(some, self.encode([units[i] for i in some])):
                    found[i] = ids
            for i in lost:
                young[units[i]] = found[i]
            if len(young) > self.most:
                self.old, self.young = young, {}
        return found


class UnitEncoder:
    """Ids (below 65,536) of texts.

    `keeps_space`: the tokenizer turns white space into ids, so units tile the
    text; otherwise they are the words between white space. `plain` encodes plain units, each as bytes of
    16-bit integers, if the tokenizer's split is known; words are cut only then.
    """

    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]], keeps_space: bool, plain: Callable[[list[bytes]], list[bytes]] | None = None):
        self.encode, self.keeps_space, self.plain, self.memo = encode, keeps_space, plain, Memo(self._made)

    def _made(self, units: list[bytes]) -> list[bytes]:
        """Ids of each unit: plain ones together, others as texts of their own."""
        is_plain = PLAIN[self.keeps_space].fullmatch if self.plain else lambda unit: None
        rest = [i for i, u in enumerate(units) if is_plain(u) is None]
        out = [b""] * len(units)
        if len(rest) < len(units):
            others = set(rest)
            some = [i for i in range(len(units)) if i not in others]
            for i, ids in zip(some, self.plain([units[i] for i in some])):
                out[i] = ids
        for i, ids in zip(rest, self.encode([units[i].decode() for i in rest]) if rest else ()):
            out[i] = np.asarray(ids, "<u2").tobytes()
        return out

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts, and the first of each text."""
        words = X.Words(data, offsets)
        inner, inside = plain_cuts(data, words, not self.keeps_space) if self.plain else (np.zeros(0, np.int64), None)
        if self.keeps_space:
            # Units begin where the word before ends; the white space that ends a text is a unit too.
            cut = np.zeros(len(data) + 1, bool)
            for places in (offsets, words.end, inner):
                cut[places] = True
            cuts = np.flatnonzero(cut)
            return X.strings(data, np.diff(cuts)), np.searchsorted(cuts, offsets)
        if not self.plain:
            return words.array(), words.first
        data = np.where(inside, _LOWER[data], data)[words.solid]
        start = np.sort(np.concatenate([words.start, inner]), kind="stable")
        return X.strings(data, np.sort(np.concatenate([words.end, inner]), kind="stable") - start), np.searchsorted(start, offsets)

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids together, and where those of each text begin; a missing text has none."""
        data, offsets = X.flat(column)
        whole = {}
        if self.keeps_space:
            # Only texts with a lead byte of other white space become strings, to be searched for it.
            lead = _LEAD[data]
            some = np.flatnonzero(np.add.reduceat(lead, offsets[:-1][np.diff(offsets) > 0])) if lead.any() else np.zeros(0, np.int64)
            some = np.flatnonzero(np.diff(offsets) > 0)[some]
            raw = data.tobytes() if len(some) else b""
            found = {int(i): raw[offsets[i]:offsets[i + 1]].decode() for i in some}
            whole = {i: np.asarray(self.encode([v])[0], "<u2") for i, v in found.items() if OTHER_SPACE.search(v)}
            if whole:
                column = pa.array([None if i in whole else v for i, v in enumerate(column.to_pylist())], pa.string())
                data, offsets = X.flat(column)
        texts = len(offsets) - 1
        units, first = self._units(data, offsets)
        code, distinct = X.codes(units)
        made = self.memo.get(X.as_list(distinct))
        every = np.frombuffer(b"".join(made), "<u2")
        size = np.array([len(m) // 2 for m in made], np.int64)
        begin = np.cumsum(size) - size
        count = size[code] if len(code) else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = every[np.repeat(begin[code] - upto[:-1], count) + np.arange(upto[-1])] if upto[-1] else np.zeros(0, "<u2")
        at = upto[first]
        if whole:
            parts = [whole.get(i, ids[at[i]:at[i + 1]]) for i in range(texts)]
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            ids = np.concatenate(parts) if parts else ids
        return ids, at


_KEPT: dict[tuple[str, str], UnitEncoder] = {}


def kept(kind: str, tokenizer_json: str, make: Callable[[], UnitEncoder]) -> UnitEncoder:
    """One encoder per Python worker, so that tasks that follow each other share its memory of units."""
    key = (kind, hashlib.sha256(tokenizer_json.encode()).hexdigest())
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def library_encoder(tokenizer_json: str) -> UnitEncoder:
    """An encoder that asks the tokenizers library for each new unit.

    The library runs in one thread, as the tasks beside it do.
    """
    return kept("library", tokenizer_json, lambda: _library_encoder(tokenizer_json))


def _library_encoder(tokenizer_json: str) -> UnitEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    keeps_space = gives_space_ids(tokenizer_json)
    library = Tokenizer.from_str(tokenizer_json)
    library.no_truncation()
    library.no_padding()
    if library.get_vocab_size() > 1 << 16:
        raise ValueError("ids must fit 16 bits")

    def encode(units: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u2") for e in library.encode_batch_fast(units, add_special_tokens=False)]

    return UnitEncoder(encode, keeps_space, _plain_encoder(tokenizer_json) if known_split(tokenizer_json) else None)


def _plain_encoder(tokenizer_json: str) -> Callable[[list[bytes]], list[bytes]]:
    """Ids of many plain units from few calls of the library: its model without the normaliser and split pattern, which leave such units as they are."""
    library = Tokenizer.from_str(tokenizer_json)
    library.no_truncation()
    library.no_padding()
    library.normalizer = None
    library.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit("\n"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    # The bytes that an id stands for: one for each letter of its name.
    width = np.zeros(max(library.get_vocab().values()) + 1, np.int64)
    for name, number in library.get_vocab().items():
        width[number] = len(name.removesuffix("</w>"))

    def encode(units: list[bytes]) -> list[bytes]:
        groups = [units[k:k + 500] for k in range(0, len(units), 500)]
        found = library.encode_batch_fast([b"\n".join(g).decode() for g in groups], add_special_tokens=False)
        out: list[bytes] = []
        for group, encoded in zip(groups, found):
            ids = np.array(encoded.ids, "<u2")
            reached, ends = np.cumsum(width[ids]), np.cumsum([len(u) for u in group])
            at = np.searchsorted(reached, ends)
            if len(reached) <= at[-1] or (reached[at] != ends).any():
                raise ValueError("ids do not end where units do")
            raw, to = ids.tobytes(), (2 * (at + 1)).tolist()
            out += [raw[a:b] for a, b in zip([0, *to], to)]
        return out

    return encode


def gives_space_ids(tokenizer_json: str) -> bool:
    """Whether the tokenizer gives ids to white space."""
    return any(len(e.ids) for e in [Tokenizer.from_str(tokenizer_json).encode(" ", add_special_tokens=False)])
