"""BPE encoding by speculation and verification, and decoding.

For vocabularies with word ends (`</w>`), lower case and dropped white space.
Each distinct word of a batch is cut greedily into the longest tokens. Such a cut
is what the merges would give exactly when every two neighbouring tokens are
compatible, that is when no merge across their border would have come before the
merges that made them. All distinct pairs are tested together with numpy, by
undoing merges on both sides of the border, the latest first. Only words with a
failing pair are merged exactly.

Defined results. A missing or empty text has no ids and decodes to empty text.
Special tokens in a text are found as they are written. Rows that repeat a
doc_id are each encoded; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from loadkit.llm import textarrays as X
from loadkit.llm.shared import columns, map_batches, schema
from loadkit.llm.unit_tokens import UnitEncoder, kept, known_split

#: Unicode's white space, and the words of the split pattern that begin with an apostrophe: fixed values.
SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
         "\u2028\u2029\u202f\u205f\u3000")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it is a visible Latin-1 letter, else the next from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


@dataclass
class Tables:
    """What a vocabulary file says, by id. `rank` is the merge that makes a token, -1 for a single byte."""

    names: list[str]
    specials: dict[str, int]
    ids: dict[bytes, int]
    ending: dict[bytes, int]
    longest: int
    #: The most bytes of a token without a word end, by its first three bytes.
    reach: dict[bytes, int]
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pairs: np.ndarray
    pair_ranks: np.ndarray
    merges: dict[tuple[int, int], tuple[int, int]]
    #: Letters and numbers as ranges of a regular expression, and the file without its model, for normalisation.
    letters: str = ""
    numbers: str = ""
    frame: str = ""


def frame_of(tokenizer_json: str) -> str:
    """The file with its normaliser and split pattern only."""
    file = json.loads(tokenizer_json)
    return json.dumps(file | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})


def classes(frame: str) -> tuple[str, str]:
    """Letters and numbers as the library has them.

    Python's tables say it for every character they know. Those they do not know,
    as newer tables may, are asked of the library's own split pattern: a letter joins
    with letters on both sides, and two numbers stay apart.
    """
    split, kinds = Tokenizer.from_str(frame).pre_tokenizer.pre_tokenize_str, {}
    for c in range(0x40000):
        kind = unicodedata.category(chr(c))
        if kind == "Cn":
            pieces = len(split(f"a{chr(c)}a"))
            kinds[c] = "L" if pieces == 1 else "N" if pieces == 3 and len(split(chr(c) * 2)) == 2 else ""
        elif kind != "Cs":
            kinds[c] = kind[0]
    return _ranges(kinds, "L"), _ranges(kinds, "N")


def _ranges(kinds: dict[int, str], kind: str) -> str:
    out, first = [], None
    for c in range(0x40001):
        inside = kinds.get(c) == kind
        if inside and first is None:
            first = c
        elif not inside and first is not None:
            out.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return "".join(out)


@functools.lru_cache(maxsize=2)
def load(tokenizer_json: str) -> Tables:
    """Tables of a vocabulary with word ends. Tokens that their own merges do not give are not proposed."""
    file = json.loads(tokenizer_json)
    model, kinds = file["model"], [n["type"] for n in (file.get("normalizer") or {}).get("normalizers", [])]
    if model.get("end_of_word_suffix") != END or kinds != ["NFC", "Replace", "Lowercase"]:
        raise ValueError("the vocabulary needs word ends and lower-case normalisation")
    specials = {t["content"]: t["id"] for t in file["added_tokens"]}
    vocab = model["vocab"]
    size = max(*vocab.values(), *specials.values()) + 1
    names = [""] * size
    for name, number in [*vocab.items(), *specials.items()]:
        names[number] = name
    rank, left, right = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
    merges, keys, ranks = {}, [], []
    for r, merge in enumerate(model["merges"]):
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        made = vocab[a + b]
        merges[vocab[a], vocab[b]] = (r, made)
        rank[made], left[made], right[made] = r, vocab[a], vocab[b]
        keys.append(vocab[a] * size + vocab[b]), ranks.append(r)
    order = np.argsort(keys)
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    ids, ending = {}, {}
    tables = Tables(names, specials, ids, ending, 0, {}, rank, left, right, np.array(keys)[order], np.array(ranks)[order], merges)
    base, last = {}, {}
    for letter, b in byte_of.items():
        base[b], last[b] = vocab[letter], vocab[letter + END]
    ids.update({bytes([b]): i for b, i in base.items()})
    ending.update({bytes([b]): i for b, i in last.items()})
    single = (dict(ids), dict(ending))
    for name, number in vocab.items():
        word_end = name.endswith(END) and name != END
        raw = bytes(byte_of[c] for c in (name[:-len(END)] if word_end else name))
        if rank[number] >= 0 and merged(raw, tables, word_end, single) == [number]:
            (ending if word_end else ids)[raw] = number
    tables.longest = max(map(len, [*ids, *ending]))
    for raw in ids:
        if len(raw) > 2:
            tables.reach[raw[:3]] = max(tables.reach.get(raw[:3], 0), len(raw))
    tables.frame = frame_of(tokenizer_json)
    tables.letters, tables.numbers = classes(tables.frame)
    return tables


def merged(word: bytes, tables: Tables, word_end: bool = True, single=None) -> list[int]:
    """The exact merges of a word: always the pair of lowest rank, the leftmost first."""
    ids, ending = single or (tables.ids, tables.ending)
    parts = [ids[word[k:k + 1]] for k in range(len(word))]
    if word_end:
        parts[-1] = ending[word[-1:]]
    size, merges = len(parts), tables.merges
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    # A heap of (rank, place of the left part, left, right, what they make); an entry whose parts have changed is passed over.
    heap = [(found[0], k, parts[k], parts[k + 1], found[1]) for k in range(size - 1) if (found := merges.get((parts[k], parts[k + 1])))]
    heapq.heapify(heap)
    while heap:
        _, k, one, two, made = heapq.heappop(heap)
        right = after[k]
        if parts[k] != one or right >= size or parts[right] != two:
            continue
        parts[k], parts[right] = made, -1
        after[k] = after[right]
        if after[k] < size:
            before[after[k]] = k
            if found := merges.get((made, parts[after[k]])):
                heapq.heappush(heap, (found[0], k, made, parts[after[k]], found[1]))
        left = before[k]
        if left >= 0 and (found := merges.get((parts[left], made))):
            heapq.heappush(heap, (found[0], left, parts[left], made, found[1]))
    return [part for part in parts if part >= 0]


def proposed(word: bytes, tables: Tables) -> list[int]:
    """The greedy cut: from the left, the longest token that fits; only the last has a word end."""
    parts, at, end, most, reach, ids, ending = [], 0, len(word), tables.longest, tables.reach, tables.ids, tables.ending
    while True:
        if end - at <= most and (last := ending.get(word[at:])) is not None:
            parts.append(last)
            return parts
        for to in range(min(end - 1, at + reach.get(word[at:at + 3], 2)), at, -1):
            if (found := ids.get(word[at:to])) is not None:
                parts.append(found)
                at = to
                break


def compatible(one: np.ndarray, two: np.ndarray, tables: Tables) -> np.ndarray:
    """Whether the merges keep the border between each two tokens.

    The tokens at the border are undone from the latest merge on. In each state a
    merge across the border would have won if its rank is below that of the
    next merge on either side; on a tie the pair further left is merged first.
    """
    size, good = len(tables.names), np.ones(len(one), bool)
    live = np.arange(len(one))
    a, b = one.astype(np.int64), two.astype(np.int64)
    limit = np.full(len(one), np.iinfo(np.int64).max)  # twice the rank of the next merge; one more if it is on the right
    while len(live):
        key = a * size + b
        at = np.minimum(np.searchsorted(tables.pairs, key), len(tables.pairs) - 1)
        crossed = (tables.pairs[at] == key) & (2 * tables.pair_ranks[at] < limit)
        good[live[crossed]] = False
        rank_a, rank_b = tables.rank[a], tables.rank[b]
        on = ~crossed & ((rank_a >= 0) | (rank_b >= 0))
        undo_a = rank_a > rank_b
        limit = np.where(undo_a, 2 * rank_a, 2 * rank_b + 1)[on]
        a, b = np.where(undo_a, tables.right[a], a)[on], np.where(undo_a, b, tables.left[b])[on]
        live = live[on]
    return good


class Words:
    """Splits units into the tokenizer's words and encodes those that are new together."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.special = re.compile("|".join(re.escape(s) for s in sorted(tables.specials, key=len, reverse=True)) or r"(?!)")
        letters, numbers = tables.letters, tables.numbers
        self.split = re.compile("|".join([*CONTRACTIONS, f"[{letters}]+", f"[{numbers}]", f"[^{SPACE}{letters}{numbers}]+"]))
        self.normalise = Tokenizer.from_str(tables.frame).normalizer.normalize_str
        self.verified: dict[int, bool] = {}
        self.exact = 0

    def words(self, text: str) -> list[bytes]:
        # The library's own normaliser, as its tables of letters may be newer than Python's.
        text = text.lower() if text.isascii() else self.normalise(text)
        return [w.encode() for w in self.split.findall(text)]

    def encode(self, units: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        places, words = [], []
        for unit in units:
            ids: list[int] = []
            out.append(ids)
            at = 0
            for match in [*self.special.finditer(unit), None]:
                for word in self.words(unit[at:match.start()] if match else unit[at:]):
                    places.append((ids, len(ids)))
                    words.append(word)
                    ids.append(-1)
                if match:
                    ids.append(self.tables.specials[match.group()])
                    at = match.end()
        for (ids, place), found in zip(reversed(places), reversed(self.encode_words(words))):
            ids[place:place + 1] = found
        return out

    def plain(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that need no splitting, as bytes of 16-bit integers."""
        return [np.array(found, "<u2").tobytes() for found in self.encode_words(words)]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        cuts = [proposed(w, self.tables) for w in words]
        size = len(self.tables.names)
        flat = np.array([t for c in cuts for t in c], np.int64)
        ends = np.cumsum([len(c) for c in cuts])
        inner = np.ones(max(0, len(flat) - 1), bool)
        inner[ends[:-1] - 1] = False
        pairs = flat[:-1][inner] * size + flat[1:][inner]
        distinct, code = np.unique(pairs, return_inverse=True)
        good = compatible(distinct // size, distinct % size, self.tables)[code]
        owner = np.searchsorted(ends, np.flatnonzero(inner), side="right")
        for k in np.unique(owner[~good]).tolist():
            cuts[k] = merged(words[k], self.tables)
            self.exact += 1
        return cuts


def own_encoder(tables: Tables, tokenizer_json: str) -> UnitEncoder:
    words = Words(tables)
    return UnitEncoder(words.encode, keeps_space=False, plain=words.plain if known_split(tokenizer_json) else None)


def encode(docs: DataFrame, tokenizer_json: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row; ids as 32-bit little-endian integers."""
    given = columns(docs, doc=doc, text=text)
    shipped = docs.sparkSession.sparkContext.broadcast(load(tokenizer_json))
    made = []

    def work(batch):
        if not made:
            made.append(kept("own", tokenizer_json, lambda: own_encoder(shipped.value, tokenizer_json)))
        ids, at = made[0].ids(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc"), _packed(ids.astype("<u4"), at)], ["doc_id", "ids"])

    return map_batches(given, work, f"doc_id {given.schema['doc'].dataType.simpleString()}, ids binary")


def _packed(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    bounds = np.ascontiguousarray(4 * at, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(ids)]).cast(pa.binary())


def decode(encoded: DataFrame, tokenizer_json: str, ids: str = "ids") -> DataFrame:
    """All columns with the decoded text: the tokens with a space between.

    The vocabulary has no decoder, so word ends stay in the text and special tokens are not left out.
    """
    names = load(tokenizer_json).names
    shipped = encoded.sparkSession.sparkContext.broadcast(names)

    def run(batches):
        for batch in batches:
            column = batch.column(ids)
            data, offsets = _bytes(column)
            tokens = _gather(data.view("<u4"), offsets // 4, shipped.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], [*batch.schema.names, "text"])

    return encoded.mapInArrow(run, schema(*encoded.schema.fields, "text string"))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset:wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw), at - at[0]


def _gather(ids: np.ndarray, at: np.ndarray, names: list[str]) -> pa.Array:
    """Token names of each text with a space between, built as one byte array."""
    spelled = [n.encode() + b" " for n in names]
    size = np.array([len(s) for s in spelled], np.int64)
    begin, every = np.cumsum(size) - size, np.frombuffer(b"".join(spelled), np.uint8)
    out, bounds = [], [0]
    for k in range(len(at) - 1):
        some = ids[at[k]:at[k + 1]]
        count = size[some]
        upto = np.cumsum(count)
        if len(some):
            text = every[np.repeat(begin[some] - (upto - count), count) + np.arange(upto[-1])][:-1]
            out.append(text)
        bounds.append(bounds[-1] + (len(text) if len(some) else 0))
    data = np.concatenate(out) if out else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(np.array(bounds, np.int64)), pa.py_buffer(data)]).cast(pa.string())
