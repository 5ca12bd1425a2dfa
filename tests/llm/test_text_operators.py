import datetime
import math
import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import BASE, LOWER, awkward, clashing, documents  # noqa: E402

from docengine.llm import language_model, line_templates, pii, toxicity  # noqa: E402

KEY = b"a key of the tests"
BAD = ["grunk", "snarf", "blort"]


# Toxicity

def labelled(spark, count=400, seed=1):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(count):
        words = [draw.choice(BASE.split()) for _ in range(draw.randrange(5, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(draw.randrange(1, 8)):
                words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(["", "", "ing", "ed"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    frame = documents(spark, docs + awkward()[6:10])
    known = spark.createDataFrame([r for r in labels if r[0] % 8 < 5] + [(None, 1, 1), (10 ** 9, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, known)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = toxicity.scored(clashing(frame.drop("lang"), "grade", "features"), model).collect()
    assert len(got) == len(docs) + 4 and got[0].features == "clash"
    truth = {i: bad for i, _, bad in labels}
    held = [r for r in got if r.doc_id in truth and r.doc_id % 8 >= 5 and r.source]
    right = sum((r.grade > 0) == bool(truth[r.doc_id]) for r in held[:140])
    assert right >= 0.95 * len(held[:140])
    assert all(0 <= r.expected_severity <= 2 and 0 <= r.p_toxic <= 1 for r in got)
    # More of it is not less severe.
    amounts = [model.beyond("alpha " + "grunk snarf blort " * k).sum() for k in (0, 1, 5, 20)]
    assert amounts == sorted(amounts) and amounts[0] < 0.5 < 1 < amounts[-1]


def test_toxicity_without_labels_rejects_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark), none)
    assert all(r.grade == 0 for r in toxicity.scored(documents(spark), model).collect())
    assert toxicity.scored(documents(spark, []), model).count() == 0


def test_ordinal_gradient():
    """The fit is where no small step of a weight or threshold makes the grades likelier."""
    draw = np.random.Generator(np.random.PCG64(1))
    score = draw.normal(size=300)
    grades = np.searchsorted([0.0, 1.0], score + draw.logistic(size=300) * 0.5)
    rows = pd.DataFrame({"features": [[1]] * 300})
    weights, thresholds = toxicity._ordinal(np.arange(300), np.zeros(300, int), score, grades, 1)

    def likelihood(w, t):
        p = np.c_[np.ones(300), 1 / (1 + np.exp(np.array(t)[None, :] - (score * w)[:, None])), np.zeros(300)]
        chance = p[np.arange(300), grades] - p[np.arange(300), grades + 1]
        return np.log(chance).mean() - toxicity.L2 / 2 * w * w

    best = likelihood(weights[0], thresholds)
    for dw, d0, d1 in [(0.05, 0, 0), (-0.05, 0, 0), (0, 0.05, 0), (0, -0.05, 0), (0, 0, 0.05), (0, 0, -0.05)]:
        assert likelihood(weights[0] + dw, thresholds + np.array([d0, d1])) <= best + 1e-4
    assert len(rows) == 300


# Personal data

@pytest.mark.parametrize("size", [1, 2, 7, 100, 999])
def test_feistel_is_a_permutation(size):
    f = pii.Feistel(KEY, "test", size)
    image = [f.permute(x) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert [f.permute(y, inverse=True) for y in image] == list(range(size))
    assert size < 100 or image != [pii.Feistel(b"other", "test", size).permute(x) for x in range(size)]


TEXT = ("Card 4111-1111-1111-1111, again 4111111111111111 and 378282246310005; not 4111111111111112. "
        "Call +1 (743) 555-3824 or 415-555-2671. Host 192.168.10.254. SSN 078-05-1120, never 000-12-3456. "
        "Account DE89370400440532013000. Born 2024-02-29, 31/12/1999, 12/31/1999, 1.2.2003; not 2023-02-29. "
        "Version 1.2.3, number 1234567890123, price 3.50.")


def test_pseudonyms_keep_formats_and_come_back():
    there, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, inverse=True)
    new, spans = there.text(TEXT)
    assert back.text(new)[0] == TEXT
    kinds = Counter(k for k, *_ in spans)
    assert kinds == {"card": 3, "phone": 2, "ip": 1, "ssn": 1, "iban": 1, "date": 4}
    assert all(new[a:z] == value for _, a, z, value in spans)
    cards = [v for k, _, _, v in spans if k == "card"]
    assert cards[0].replace("-", "") == cards[1] and cards[0][4] == "-"  # equal values stay equal
    for c in cards:
        digits = c.replace("-", "")
        assert pii.luhn_digit(digits[:-1]) == int(digits[-1])
    iban = next(v for k, _, _, v in spans if k == "iban")
    assert iban[:2] == "DE" and pii.iban_check("DE", iban[4:]) == iban[2:4]
    for kept in ("4111111111111112", "000-12-3456", "2023-02-29", "1.2.3", "3.50", "Version"):
        assert kept in new
    assert pii.Pseudonyms(b"other").text(TEXT)[0] != new


def test_random_values_round_trip():
    draw = random.Random(2)
    there, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, inverse=True)
    for _ in range(400):
        body = "".join(draw.choice("0123456789") for _ in range(draw.choice([12, 15, 18])))
        values = [body + str(pii.luhn_digit(body)), ".".join(str(draw.randrange(256)) for _ in range(4)),
                  f"{draw.randrange(1, 32):02d}/{draw.randrange(1, 13):02d}/{draw.randrange(1900, 2100)}",
                  f"+1 ({draw.randrange(1000):03d}) {draw.randrange(1000):03d}-{draw.randrange(10000):04d}"]
        text = " and ".join(values)
        new, spans = there.text(text)
        assert back.text(new)[0] == text and len(new) == len(text) + sum(
            len(z) - len(v) for v, z in zip(values, new.split(" and ")))


@pytest.mark.parametrize("kind, value", [
    ("iban", "GB82WEST12345698765432"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "NL91ABNA0417164300"),
    ("iban", "FR14 2004 1010 0505 0001 3M02 606"), ("iban", "IT60 X054 2811 1010 0000 0123 456"),
    ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "BE68 5390 0754 7034"), ("iban", "DE89370400440532013000"),
    ("phone", "+1-555-123-4567"), ("phone", "1-800-555-1234"), ("phone", "+1 555 123 4567"), ("phone", "+1.555.123.4567"),
    ("phone", "(555)123-4567"), ("phone", "(555) 123-4567"), ("phone", "555-123-4567"), ("phone", "+15551234567"),
    ("phone", "+442079460958"), ("phone", "+44 20 7946 0958"), ("phone", "+49 (0)30 123456"), ("phone", "+33 1 23 45 67 89"),
    ("phone", "+353-1-234-5678"), ("phone", "+61 2 9374 4000")])
@pytest.mark.parametrize("around", ["{}", "Write to {}, or not.", "at {} AND MORE on 2024-02-29", "[{}]"])
def test_forms_of_ibans_and_phones(kind, value, around):
    text = around.format(value)
    new, spans = pii.Pseudonyms(KEY).text(text)
    assert [k for k, *_ in spans if k != "date"] == [kind]
    found = next(v for k, *_, v in spans if k == kind)
    assert found != value and len(found) == len(value)
    same = lambda c: "9" if c.isdigit() else "A" if c.isalpha() else c
    assert "".join(map(same, found)) == "".join(map(same, value))
    assert pii.Pseudonyms(KEY, inverse=True).text(new)[0] == text
    if kind == "iban":
        plain = found.replace(" ", "")
        assert plain[:2] == value[:2] and pii.iban_check(plain[:2], plain[4:]) == plain[2:4]


def test_equal_accounts_and_numbers_stay_equal():
    names = pii.Pseudonyms(KEY)
    one = lambda t: names.text(t)[1][0][3]
    assert one("GB82 WEST 1234 5698 7654 32").replace(" ", "") == one("GB82WEST12345698765432")
    digits = lambda t: "".join(c for c in one(t) if c.isdigit())[-10:]
    assert len({digits(t) for t in ("+1-555-123-4567", "(555)123-4567", "555.123.4567", "+15551234567")}) == 1
    assert one("+44 20 7946 0958").replace(" ", "") == one("+442079460958") != "+442079460958"


def test_international_numbers_leave_their_neighbours():
    for text, kinds in (("+1 10.0.0.1", ["ip"]), ("+10.0.0.1", ["ip"]), ("+1 2024-02-29", ["date"]),
                        ("+12.12.2024", ["date"]), ("+49 078-05-1120", ["ssn"]),
                        ("+12345678 4111 1111 1111 1111", ["phone", "card"]), ("+31.20.123.45.67", ["phone"])):
        new, spans = pii.Pseudonyms(KEY).text(text)
        assert [k for k, *_ in spans] == kinds
        assert pii.Pseudonyms(KEY, inverse=True).text(new)[0] == text


def test_wrong_ibans_stay_and_hide_nothing():
    for text in ("GB83WEST12345698765432", "GB83 WEST 1234 5698 7654 32", "AB12CDEFGHIJKLMNOPQ", "DE12 ABCD"):
        assert pii.Pseudonyms(KEY).text(text) == (text, [])
    # A card or a phone after what looks like the head of a grouped IBAN.
    for text, kind in (("DE12 4111 1111 1111 1111 22", "card"), ("DE12 555-123-4567", "phone")):
        assert [k for k, *_ in pii.Pseudonyms(KEY).text(text)[1]] == [kind]


def test_pseudonymized_tables(spark):
    rows = [(1, TEXT), (2, "the same 4111111111111111"), (3, None), (4, ""), (2, "the same 4111111111111111")]
    docs = clashing(documents(spark, rows), "pii_values", "kind")
    got = pii.pseudonymized(docs, KEY).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 2, 3, 4] and got[0].kind == "clash"
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].text is None and by_id[4].text == "" and not by_id[3].pii_values
    assert by_id[2].pii_values[0].pseudonym in {v.pseudonym for v in by_id[1].pii_values}
    back = pii.restored(pii.pseudonymized(documents(spark, rows), KEY), KEY).collect()
    assert {(r.doc_id, r.text) for r in back} == set(rows)
    assert pii.pseudonymized(documents(spark, []), KEY).count() == 0
    with pytest.raises(ValueError):
        pii.Pseudonyms(b"")


# Line templates

def brute_lines(rows):
    """(doc_id, text, n_lines, n_dropped) by the rules, with plain loops."""
    def masked(line):
        return [("<*>" if any(c in "0123456789" for c in t) else t) for t in line.split(" ") if t]

    docs = {r for r in rows if r[1] is not None}
    lines = []
    for d in docs:
        forms = [masked(x) for x in d[1].split("\n")]
        names = [" ".join(f) for f in forms]
        for k, f in enumerate(forms):
            if len(f) >= line_templates.LEAST_TOKENS:
                before, after = names[k - 1] if k else None, names[k + 1] if k + 1 < len(names) else None
                lines.append((d, k, tuple(f), (len(f), *f[:line_templates.LEADING]), (before, after)))
    common = {}
    for _, _, f, leaf, _ in lines:
        for p, t in enumerate(f):
            common.setdefault((leaf, p), Counter())[t] += 1
    common = {k: max(c, key=lambda t: (c[t], t.encode())) for k, c in common.items()}
    bodies = {}
    for _, _, f, leaf, _ in lines:
        bodies.setdefault(leaf, set()).add(f)
    def template(f, leaf):
        same = sum(common[leaf, p] == t for p, t in enumerate(f))
        follows = len(bodies[leaf]) > 1 and same >= line_templates.AGREE * len(f)
        return (True, leaf) if follows else (False, f)

    first = {}
    for d, k, f, leaf, context in sorted(lines, key=lambda x: x[1]):
        first.setdefault(template(f, leaf), {}).setdefault(d, context)
    gone = {t for t, by in first.items()
            if len(by) >= line_templates.LEAST_DOCS and len(set(by.values())) >= line_templates.LEAST_CONTEXTS}
    dropped = {(d, k) for d, k, f, leaf, _ in lines if template(f, leaf) in gone}
    out = []
    for d in rows:
        if d[1] is None:
            out.append((*d, 0, 0))
            continue
        parts = d[1].split("\n")
        kept = [x for k, x in enumerate(parts) if (d, k) not in dropped]
        out.append((d[0], "\n".join(kept), len(parts), len(parts) - len(kept)))
    return out


def test_line_templates(spark):
    draw = random.Random(4)
    rows = list(awkward())
    for i in range(40):
        body = [" ".join(draw.choice(BASE.split()) for _ in range(draw.randrange(1, 9))) for _ in range(5)]
        body.insert(draw.randrange(5), f"Page {i} of {draw.randrange(99)} printed by {draw.choice(['Ann', 'Bob', 'Cy'])}")
        body.insert(draw.randrange(5), "All rights reserved by the authors.")
        rows.append((100 + i, "\n".join(body)))
    copy = "\n".join(["this line stands in copies only", "and this one does so too", "with a third as well"])
    rows += [(200 + i, copy) for i in range(6)]
    docs = clashing(documents(spark, rows), "row", "drop_lines", "leaf", "n_lines")
    got = line_templates.without_templates(docs).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=repr) == sorted(brute_lines(rows), key=repr)
    assert got[0].row == got[0].drop_lines == "clash"
    by_id = {r.doc_id: r.text for r in got}
    assert "rights" not in by_id[100] and "Page" not in by_id[110] and by_id[203] == copy
    assert line_templates.without_templates(documents(spark, [])).count() == 0


def test_line_templates_hold_one_table_of_lines_at_a_time(spark, monkeypatch):
    held, before = [], {}
    write, drop = line_templates.Scratch.write, line_templates.Scratch.drop

    def written(self, df, name, *rest):
        before[name] = list(held)
        held.append(name)
        return write(self, df, name, *rest)

    def dropped(self, *names):
        held[:] = [n for n in held if n not in names]
        drop(self, *names)

    monkeypatch.setattr(line_templates.Scratch, "write", written)
    monkeypatch.setattr(line_templates.Scratch, "drop", dropped)
    docs = documents(spark)
    line_templates.without_templates(docs)
    # Templates are counted on narrow rows, with the table of keys gone.
    assert before["found"] == ["named"] and held == ["drops"]
    assert dict(line_templates.parsed(docs).dtypes)["context"] == "bigint"


def test_line_templates_use_no_python(spark):
    plan = line_templates.without_templates(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Language model

def test_forward_is_the_sum_over_paths():
    from itertools import product

    draw = np.random.Generator(np.random.PCG64(2))
    model = language_model.Model(np.array([0.3, 0.7]), np.array([[0.8, 0.2], [0.4, 0.6]]),
                                 draw.random((language_model.CLASSES + 1, 2)), np.ones(1))
    codes = np.array([3, 5, 3, 9, 1, 2])
    steps = language_model.Lockstep(np.array([0, 4]), np.array([4, 2]))
    got = steps.forward(model, codes)[0][np.argsort(steps.order)]
    for (start, n), value in zip(((0, 4), (4, 2)), got):
        own = codes[start:start + n]
        total = 0.0
        for path in product(range(2), repeat=n):
            p = model.start[path[0]]
            for t, s in enumerate(path):
                p *= (model.move[path[t - 1], s] if t else 1) * model.emit[own[t], s]
            total += p
        assert abs(value - math.log10(total)) < 1e-9


def test_expected_counts_are_those_over_paths():
    from itertools import product

    draw = np.random.Generator(np.random.PCG64(3))
    model = language_model.Model(np.array([0.6, 0.4]), np.array([[0.5, 0.5], [0.1, 0.9]]),
                                 draw.random((language_model.CLASSES + 1, 2)), np.ones(1))
    own = np.array([7, 1, 7, 4])
    first, moves, emitted, likely = language_model.Lockstep(np.array([0]), np.array([4])).expected(model, own)
    chances = {}
    for path in product(range(2), repeat=4):
        p = model.start[path[0]] * model.emit[own[0], path[0]]
        for t in range(1, 4):
            p *= model.move[path[t - 1], path[t]] * model.emit[own[t], path[t]]
        chances[path] = p
    total = sum(chances.values())
    assert abs(likely - math.log10(total)) < 1e-9
    assert np.allclose(first, [sum(p for x, p in chances.items() if x[0] == k) / total for k in (0, 1)])
    for a in (0, 1):
        for b in (0, 1):
            assert abs(moves[a, b] - sum(p * sum(x[t] == a and x[t + 1] == b for t in range(3))
                                         for x, p in chances.items()) / total) < 1e-9
    assert abs(emitted[7, 1] - sum(p * ((x[0] == 1) + (x[2] == 1)) for x, p in chances.items()) / total) < 1e-9
    assert abs(emitted.sum() - 4) < 1e-9


def language_rows():
    draw = random.Random(7)
    vocab = [[f"{p}{k}" for k in range(30)] for p in "ab"]
    return [(i, " ".join(draw.choice(vocab[i % 2]) for _ in range(draw.randrange(3, 90)))) for i in range(300)]


def test_language_model_scores(spark):
    rows = language_rows() + awkward()
    got = language_model.scored(clashing(documents(spark, rows), "block", "codes", "held"), iterations=4).collect()
    words = lambda t: [w for w in (t or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if w]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in [*words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    wanted = Counter()
    for i, t in rows:
        own = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        wanted[i, held(i), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in got) == wanted
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score <= 1e-9 for r in got)


def test_small_and_empty_tables(spark):
    rows = [(i, w) for i, w in enumerate("a b c a b a d e f a b c".split())]
    got = language_model.scored(documents(spark, rows), states=2, iterations=2).collect()
    assert len(got) == 12 and all(r.n_tokens == 2 for r in got)
    assert language_model.scored(documents(spark, []), iterations=1).count() == 0
    unseen = [(i, "x") for i in range(40) if language_model.held_out(i)]
    only = language_model.scored(documents(spark, unseen), iterations=1).collect()
    assert all(abs(r.score) < 1e-9 and r.base_score == 0 and r.train_tokens == 0 for r in only)


def test_first_model_is_a_distribution():
    tokens = np.zeros(language_model.CLASSES)
    tokens[[3, 8, 20]] = [5, 1, 4]
    model = language_model.first_model(tokens, 3)
    assert np.allclose(model.emit[:-1].sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)
    assert abs(model.start.sum() - 1) < 1e-12 and (model.emit[-1] == 1).all()


def test_notations_of_one_day_stay_linked():
    """Every day of a few years in all notations: one pseudonym, read back, and no two days meet."""
    there, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, inverse=True)
    day, images = datetime.date(1999, 1, 1), {}
    while day < datetime.date(2005, 1, 1):
        forms = [f"{day:%Y-%m-%d}", f"{day:%d.%m.%Y}", f"{day:%m/%d/%Y}"] + ([f"{day:%d/%m/%Y}"] if day.day > 12 else [])
        new = [there.text(f)[0] for f in forms]
        iso = datetime.date.fromisoformat(new[0])
        assert new[1:] == [f"{iso:%d.%m.%Y}", f"{iso:%m/%d/%Y}", f"{iso:%d/%m/%Y}"][:len(forms) - 1]
        assert [back.text(t)[0] for t in new] == forms
        images[iso] = day
        day += datetime.timedelta(days=1)
    assert len(images) == 2192 and sum(a == b for a, b in images.items()) < 10
