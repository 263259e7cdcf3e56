from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def _valid(plan, items, capacity):
    lengths = np.array(items)
    order = np.argsort(lengths, kind="stable")
    lengths = lengths[order]
    rank = np.arange(len(lengths)) - np.searchsorted(lengths, lengths)
    sequence, offset = plan.place(lengths, rank)
    held = {}
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist()):
        held.setdefault(s, []).append((o, n))
    for parts in held.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert sorted(held) == list(range(plan.sequences))


def _fewest(items, capacity):
    """Exact number of bins by exhaustive search."""
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] + items[i]] + bins[k + 1 :])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


def _histogram(items):
    return {k: len(list(g)) for k, g in itertools.groupby(sorted(items))}


def test_plans_are_valid_and_near_the_fewest():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.choice((10, 20, 37))
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 11))), reverse=True)
        plan = packing.Plan(_histogram(items), capacity)
        _valid(plan, items, capacity)
        assert _fewest(items, capacity) <= plan.sequences <= _fewest(items, capacity) + 1


def test_dominance_fixes_nothing_that_costs_a_bin():
    rng = random.Random(3)
    for _ in range(80):
        capacity = rng.choice((9, 15, 24))
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(2, 9))), reverse=True)
        left = _histogram(items)
        plan = packing.Plan.__new__(packing.Plan)
        plan.capacity, plan.sequences, plan.rows, plan._next = capacity, 0, [], dict.fromkeys(left, 0)
        fixed = plan._reduce(left)
        rest = sorted((k for k, n in left.items() for _ in range(n)), reverse=True)
        assert fixed + _fewest(rest, capacity) == _fewest(items, capacity)


@pytest.mark.parametrize(("n", "top", "capacity"), [(50_000, 900, 4096), (20_000, 4096, 4096), (5000, 3, 4096), (3000, 60, 100)])
def test_large_plans(n, top, capacity):
    rng = random.Random(n)
    items = [min(top, max(1, int(rng.expovariate(3 / top)))) for _ in range(n)]
    plan = packing.Plan(_histogram(items), capacity)
    _valid(plan, items, capacity)
    assert plan.sequences <= -(-sum(items) // capacity) * 1.01 + 1


def test_words_encode_like_texts():
    rng = random.Random(4)
    parts = [*"abcDEZ019.,!?'’\"-_<|>★☃éÉßİΣς日́  \x1c\x85\t\n  sltdm ", "<|endoftext|>", "<|startoftext|>", "'s", "'re", "...", ", ", ". ", "<|ENDOFTEXT|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(2500)]
    expected = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing._encode(texts, PATH)] == expected


def test_words_with_nul_keep_their_ids_and_their_neighbours():
    texts = ["xq a\0b yq zq", "nul\0 \0 \0\0end, other. words", "★ a★b \0★\0 last", "tail after them"]
    expected = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    packing._tokenizer.cache_clear()
    assert [np.frombuffer(b, "<u4").tolist() for b in packing._encode(texts, PATH)] == expected


@pytest.mark.parametrize("mark", ["a", "qqzzxxqq"])
def test_lines_that_do_not_come_apart_are_encoded_by_word(monkeypatch, mark):
    """Marks that words of the line hold as well, or whose id is not one."""
    monkeypatch.setattr(packing, "_BETWEEN", mark)
    packing._tokenizer.cache_clear()
    texts = ["b a c", "a", "d a e f"]
    expected = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing._encode(texts, PATH)] == expected
    packing._tokenizer.cache_clear()


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    for _ in range(3):
        assert [len(b) for b in packing._encode(["some words here, again.", "more words. here", ""], PATH)][2] == 0


def test_query(spark, odd_docs, docs_of, stored_tables):
    rows = queries.op10_packing(spark, stored_tables(documents=odd_docs)).collect()
    tokenizer, expected = Tokenizer.from_file(PATH), []
    for r in odd_docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for n, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            expected.append((str(r["doc_id"]), n, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096
    assert len(held) <= -(-sum(r["length"] for r in rows) // 4096) + 1
    assert queries.op10_packing(spark, stored_tables(documents=docs_of([]))).count() == 0


def test_words_of_letters_come_apart_without_marks_between():
    """Each such word is one unit, so that lines of them need no mark between; other tokenizers get the longer way."""
    light, last = packing._letters(PATH)
    words = ["resttionha", "ciónadomido", "été", "a", "straße"]
    ids = light.encode(" ".join(words), add_special_tokens=False).ids
    assert ids == Tokenizer.from_file(PATH).encode(" ".join(words), add_special_tokens=False).ids
    assert int(last[ids].sum()) == len(words)
    assert [packing._of_letters(w.encode()) for w in ("É", "ab", "i̇é", "λό", "é1")] == ["é", None, None, None, None]


def test_marks_after_letters_are_units_of_their_own():
    texts = ["ab.%%% ab,*** ab!! ab' ab'. ab's. ab<| ab|> é.., a-b-- İx. Éa###"]
    expected = [Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids for t in texts]
    packing._tokenizer.cache_clear()
    assert [np.frombuffer(b, "<u4").tolist() for b in packing._encode(texts, PATH)] == expected
    known = packing._tokenizer(PATH)[1]
    assert b".%%%" in known and known[b"ab.%%%"] == known[b"ab"] + known[b".%%%"]
