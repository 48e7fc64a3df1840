"""The compiled vocabularies against the library on every code point."""

import random

import numpy as np
import public_tokenizers
import pytest
from tillstream.llm.lookup import Lookup
from tillstream.llm.pack import WordIds
from tillstream.llm.tokens import count_tokens
from tillstream.llm.transducer import machine_of

POINTS = [*range(0xD800), *range(0xE000, 0x110000)]
# Blocks whose characters all behave alike are tried at every 40th point.
ALIKE = [(0x3400, 0x9FF0), (0xAC00, 0xD7A0), (0xE000, 0xF8FF), (0x17000, 0x18CD0), (0x20000, 0x2A6D0),
         (0x2A700, 0x2EBE0), (0x30000, 0x31340), (0x32400, 0xE0000), (0xE0200, 0x110000)]


def texts():
    tried = [p for p in POINTS if p % 40 == 0 or not any(a < p < b for a, b in ALIKE)]
    for at in range(0, len(tried), 2000):
        yield [f"a{chr(p)}1 {chr(p)}{chr(p)}b" for p in tried[at : at + 2000]]


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def test_ids_of_every_code_point():
    own, name = WordIds(public_tokenizers.path("word_bpe_49k.json")), library("word_bpe_49k.json")
    for some in texts():
        want = [e.ids for e in name.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(some)] == want


def test_counts_of_every_code_point():
    machine, name = machine_of(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    for some in texts():
        want = [len(e.ids) for e in name.encode_batch(some, add_special_tokens=False)]
        assert count_tokens(some, machine).tolist() == want


def test_a_machine_stays_within_its_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, name = WordIds(path), library("word_bpe_49k.json")
    own.machine.max_bytes, kept = 3 << 20, own.machine.max_bytes
    pick, most = random.Random(3), 0
    for _ in range(30):
        some = ["".join(pick.choice("abcdehilnorst ") for _ in range(400)) for _ in range(20)]
        want = [e.ids for e in name.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(some)] == want
        most = max(most, own.machine.held_bytes())
    own.machine.max_bytes = kept
    assert most < 8 << 20


@pytest.mark.parametrize("size", [1, 1000, 300_000])
def test_lookup(size):
    pick = np.random.default_rng(size)
    keys = np.unique(pick.integers(0, 1 << 40, 2 * size))
    held, others = keys[::2], keys[1::2]
    table = Lookup()
    for some in np.array_split(pick.permutation(held), 5):
        table.add(some, (some % 1000).astype(np.int32))
    assert (table.find(held) == held % 1000).all() and (table.find(others) == -1).all()
