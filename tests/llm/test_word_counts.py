"""Token counts by distinct words against the library, with every kind of character."""

import random
import sys
import unicodedata

import pytest

from opsflow.llm import token_count
from opsflow.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def content():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def library(content, texts):
    tokenizer = token_count.load(content)
    return [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]


def test_every_character_between_others(content):
    rng = random.Random(1)
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    # All of the lower planes' odd classes, and a spread of the rest.
    picked = [c for c in chars if ord(c) < 0x3100 or unicodedata.category(c) in ("Zs", "Zl", "Zp", "Cf", "Nl", "No")] + rng.sample(chars, 20_000)
    texts = ["".join(f"{rng.choice(['a', '1', '?', ' ', '', '  ', chr(10), chr(39)])}{c}" for c in picked[k:k + 50]) for k in range(0, len(picked), 50)]
    assert token_count.WordCounts(content).counts(texts) == library(content, texts)


def test_words_blanks_and_special_strings(content):
    rng = random.Random(2)
    bits = ["it's", " we'll", "'d", "  ", "\n\n", "\t x", " <|endoftext|>", "<|endof", "text|>", "naïve", " 123", "４５", "Straße", "x" * 300,
            " ", " ", "\x1c", "\x85", "​", "é", "한국어", "😀", "…", " .", "'", "\r\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(600)] + ["", " ", "<|endoftext|>"]
    counter = token_count.WordCounts(content)
    assert counter.counts(texts) == library(content, texts) == counter.counts(texts)
    assert max(map(len, counter.known)) <= counter.MAX_LETTERS


def test_words_are_dropped_when_there_are_too_many(content, monkeypatch):
    monkeypatch.setattr(token_count.WordCounts, "MAX_WORDS", 20)
    counter = token_count.WordCounts(content)
    texts = [" ".join(f"word{i}x{j}" for i in range(9)) for j in range(8)]
    assert [counter.counts([t])[0] for t in texts] == library(content, texts) and len(counter.known) <= 40


def test_other_tokenizers_are_left_to_the_library(content):
    assert token_count.WordCounts(content).usual
    odd = content.replace('"add_prefix_space":false', '"add_prefix_space":true', 1).replace('"add_prefix_space": false', '"add_prefix_space": true', 1)
    counter = token_count.WordCounts(odd)
    assert not counter.usual and counter.counts(["one two", ""]) == library(odd, ["one two", ""])
