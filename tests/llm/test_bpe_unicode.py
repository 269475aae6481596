"""Token ids of every code point equal the library's, alone and inside a word."""

import random

from martlet.llm import bpe, queries


def test_every_code_point():
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    known, rules = Tokenizer.from_file(path), bpe.WordBPE.load(path)
    points = [c for c in [*range(0x33480), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000]
    wrong = []
    for at in range(0, len(points), 1 << 14):
        texts = [f"a{chr(c)}b {chr(c).upper()}1" for c in points[at:at + (1 << 14)]]
        for text, want in zip(texts, known.encode_batch(texts, add_special_tokens=False)):
            if list(rules.encode(text)) != want.ids:
                wrong.append(hex(ord(text[1])))
    assert wrong == []


def test_random_texts_of_rare_characters():
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    known, rules = Tokenizer.from_file(path), bpe.WordBPE.load(path)
    rnd = random.Random(6)
    pool = [*range(0x20, 0x7F), *range(0xA0, 0x600), *range(0x880, 0xE00), *range(0x1C80, 0x1D00), *range(0xA7C0, 0xA7F8),
            *range(0x10D40, 0x10D90), *range(0x16EA0, 0x16EE0), *range(0x300, 0x370)]
    pool += [c for a, b in bpe.LATER_MARKS for c in range(a, b + 1)] * 3
    texts = ["".join(chr(rnd.choice(pool)) for _ in range(rnd.randint(1, 40))) for _ in range(4000)]
    bad = [t for t, want in zip(texts, known.encode_batch(texts, add_special_tokens=False)) if list(rules.encode(t)) != want.ids]
    assert bad == []
