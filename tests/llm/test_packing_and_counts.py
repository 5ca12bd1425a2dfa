import random
import sys
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import awkward, clashing, documents  # noqa: E402

from docengine.llm import packing, token_counts  # noqa: E402
from docengine.llm.tokens import Encoder, tokenizer_path  # noqa: E402


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


def direct(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_parts_have_the_ids_of_the_whole_text(encoder):
    draw = random.Random(1)
    letters = "abcXYZéÉßİıŉªµſ0129.,;:!?'’\"-_ \n\t\x0b\x1c\xa0 ǅ中あ🙂ё́<|endoftext|>"
    cases = ["", " ", "I'm, it's. x.., 3.14", "<|endoftext|> a<|startoftext|>b", "ÉCOLE École. Straße, ẞ."]
    cases += ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(800)]
    for text in cases:
        assert encoder.text(text) == np.array(direct(encoder, text), "<u4").tobytes(), repr(text)


def test_pieces_and_packing(spark, encoder):
    rows = awkward()
    got = packing.pack(clashing(documents(spark), "length", "piece", "ids"), capacity=64, keep_ids=True)
    got = got.collect()
    wanted = Counter()
    for doc_id, text in rows:
        ids = direct(encoder, text) + [0]
        for at in range(0, len(ids), 64):
            part = np.array(ids[at:at + 64], "<u4").tobytes()
            wanted[doc_id, at // 64, at, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // 64) + 2


def test_sequences_hold_their_pieces(spark):
    packed = packing.pack(documents(spark), capacity=128, keep_ids=True)
    ids = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert bytes(ids[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)]) == bytes(r.ids)


def test_plan_fills_bins():
    draw = random.Random(3)
    counts = Counter(draw.randrange(1, 2049) for _ in range(3000))
    found = packing.plan(counts)
    total = sum(n * c for n, c in counts.items())
    assert found.sequences <= -(-total // 2048) * 1.02 + 1
    used = Counter()
    for length, _, _, k, _ in found.rows:
        used[length] += 0 * k
    assert set(used) == set(counts)
    with pytest.raises(ValueError):
        packing.plan({0: 1})


def test_fullest_is_the_best_sum():
    from itertools import combinations

    draw = random.Random(4)
    for _ in range(40):
        items = [draw.randrange(1, 40) for _ in range(9)]
        left = Counter(items)
        used = packing.fullest(dict(left), 60)
        assert all(used[n] <= left[n] for n in used) and used[max(items)] >= 1
        rest = list(items)
        rest.remove(max(items))
        best = max(sum(c) for k in range(len(rest) + 1) for c in combinations(rest, k) if sum(c) + max(items) <= 60)
        assert sum(n * k for n, k in used.items()) == best + max(items)


def test_empty_tables(spark):
    empty = documents(spark, []) 
    assert packing.pack(empty).count() == 0
    assert token_counts.context_table(token_counts.histogram(empty)).count() == 0


def test_token_counts(spark, encoder):
    rows = awkward()
    lengths = [len(direct(encoder, t)) for _, t in rows]
    answers = token_counts.context_table(token_counts.histogram(clashing(documents(spark), "length", "n_docs"))).cache()
    for r in answers.collect():
        n = r.length
        assert r.n_docs == lengths.count(n)
        assert r.docs_over == sum(x > n for x in lengths) and r.docs_within == sum(x <= n for x in lengths)
        assert r.tokens_over == sum(x for x in lengths if x > n)
        assert r.tokens_kept == sum(min(x, n) for x in lengths)
        assert r.tokens_cut == sum(max(x - n, 0) for x in lengths)
    assert answers.count() == len(set(lengths))
    for limit in (0, 1, 7, 33, 500, 10 ** 6):
        assert token_counts.at_limit(answers, limit).first().tokens_kept == sum(min(x, limit) for x in lengths)
    middle = token_counts.quantile(answers, 0.5).first().length
    assert sum(x <= middle for x in lengths) >= len(lengths) / 2 > sum(x < middle for x in lengths)
