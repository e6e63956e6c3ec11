"""Both encoders against the library: every code point, mixed strings, and very long words."""

import random
import time
import unicodedata
from pathlib import Path

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loadkit.llm import speculative_bpe, unit_tokens

POINTS = [c for c in [*range(0x34000), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000]
SPACES = [chr(c) for c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F,
                           0x2060, 0x3000, 0xFEFF)]


def vocabulary(name):
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def library(name, texts):
    found = Tokenizer.from_str(vocabulary(name)).encode_batch(texts, add_special_tokens=False)
    return [e.ids for e in found]


@pytest.fixture(scope="module")
def own():
    tables = speculative_bpe.load(vocabulary("word_bpe_49k.json"))
    return unit_tokens.UnitEncoder(speculative_bpe.Words(tables).encode, keeps_space=False)


def ids_of(encoder, texts):
    ids, at = encoder.ids(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def mixed(seed, count):
    pick = random.Random(seed)
    kinds = ["abc XYZ don't 'LL 12", "Σς ΑΣ. É é é ﬁ İ ı ß ẞ", "日本語 한국 ไทย", "🙂👍🏽 ☃ ½ Ⅷ ٣", "<|endoftext|> </w> <|", "\x00\x01\x7f‍­"]
    pieces = [*kinds, *SPACES, *(chr(pick.choice(POINTS)) for _ in range(600))]
    return ["".join(pick.choices(pieces, k=pick.randrange(1, 9))) for _ in range(count)]


@pytest.mark.parametrize("form", ["{}", "a{}a", "{0}{0}", "7{}'s "])
def test_every_code_point(own, form):
    texts = [form.format(chr(c)) for c in POINTS]
    assert [t for t, a, b in zip(texts, ids_of(own, texts), library("word_bpe_49k.json", texts)) if a != b] == []


def test_mixed_strings(own):
    texts = mixed(1, 20_000)
    assert [t for t, a, b in zip(texts, ids_of(own, texts), library("word_bpe_49k.json", texts)) if a != b] == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_library_encoder_on_mixed_strings(name):
    texts = mixed(2, 10_000) + [None, "", " ", "x" * 50_000]
    encoder = unit_tokens.library_encoder(vocabulary(name))
    assert ids_of(encoder, texts) == library(name, [t or "" for t in texts])


def test_white_space_beyond_ascii_gives_no_ids(own):
    assert ids_of(own, ["s \x00>", "a　b", *SPACES[10:11]])[0] == library("word_bpe_49k.json", ["s \x00>"])[0]
    assert all(unicodedata.category(c) in ("Zs", "Zl", "Zp", "Cc") for c in speculative_bpe.SPACE) and len(set(speculative_bpe.SPACE)) == 25


def test_a_word_of_a_megabyte_takes_seconds(own):
    pick = random.Random(4)
    word = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    start = time.perf_counter()
    got = ids_of(own, [word])[0]
    assert time.perf_counter() - start < 60
    assert got == library("word_bpe_49k.json", [word])[0]


@pytest.mark.parametrize("kind", ["word_bpe_49k.json", "byte_bpe_50k.json", "own"])
def test_cut_words_at_every_code_point(kind):
    name = "word_bpe_49k.json" if kind == "own" else kind
    encoder = speculative_bpe.own_encoder(speculative_bpe.load(vocabulary(name)), vocabulary(name)) if kind == "own" else unit_tokens.library_encoder(vocabulary(name))
    assert encoder.plain
    for form in ("Éa{}b12.", " {0}1{0}+Ü", "\n('{}s,Zß"):
        texts = [form.format(chr(c)) for c in POINTS if c < 0x3000 or c % 7 == 0]
        assert [t for t, a, b in zip(texts, ids_of(encoder, texts), library(name, texts)) if a != b] == []


def test_plain_words_share_units():
    encoder = unit_tokens._library_encoder(vocabulary("word_bpe_49k.json"))
    text = "word Word, (word) WORD12 Éa éa. it's"
    assert ids_of(encoder, [text]) == library("word_bpe_49k.json", [text])
    assert set(encoder.memo.young) == {b"word", b",", b"(", b")", b"1", b"2", "éa".encode(), b".", b"it's"}
    encoder = unit_tokens._library_encoder(vocabulary("byte_bpe_50k.json"))
    assert ids_of(encoder, [" Word, Word."]) == library("byte_bpe_50k.json", [" Word, Word."])
    assert set(encoder.memo.young) == {b" Word", b",", b"."}


def test_other_files_are_not_cut():
    import json
    file = json.loads(vocabulary("byte_bpe_50k.json"))
    assert unit_tokens.known_split(json.dumps(file))
    file["pre_tokenizer"]["add_prefix_space"] = True
    assert not unit_tokens.known_split(json.dumps(file))


def test_greedy_cut_is_the_longest_token():
    tables = speculative_bpe.load(vocabulary("word_bpe_49k.json"))
    for word in (b"internationalisation", b"zq", b"thouened", "übergrößen".encode(), b"a" * 300):
        parts, at = [], 0
        while word[at:] not in tables.ending:
            to = max(k for k in range(at + 1, len(word)) if word[at:k] in tables.ids)
            parts.append(tables.ids[word[at:to]])
            at = to
        assert speculative_bpe.proposed(word, tables) == [*parts, tables.ending[word[at:]]]
    assert tables.reach[b"the"] == max(len(t) for t in tables.ids if t.startswith(b"the"))
