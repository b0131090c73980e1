"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from windrow.llm import variants
from windrow.llm.arrow import let_workers_import


def near(a, b):
    """One insertion, deletion or replacement apart."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected_rows(counts, factor=5):
    forms, rows = {}, {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= factor * n:
            forms[w] = best
        rows[w] = [n, len(others)]
    found = {}
    for w, (n, n_near) in rows.items():
        root = w
        while root in forms:
            root = forms[root]
        found[w] = (forms.get(w), root, n, n_near, counts.get(forms.get(w)))
    return found


@pytest.fixture(scope="module")
def counts():
    draw = random.Random(13)
    made = {}
    for _ in range(60):
        base = "".join(draw.choice("abcé") for _ in range(draw.randrange(6, 14)))
        for _ in range(12):
            word = list(base)
            for _ in range(draw.randrange(4)):
                kind, at = draw.randrange(3), draw.randrange(len(word))
                if kind == 0:
                    word[at] = draw.choice("abcdé")
                elif kind == 1:
                    word.insert(at, draw.choice("abÀ"))
                else:
                    del word[at]
            if len(word) >= 6:
                made["".join(word)] = draw.choice([5, 6, 25, 30, 125, 700, 4000])
    made.update({"x" * n: 5 * n for n in (6, 7, 8, 300, 301)})
    made.update({"é" * 200 + "a": 5, "é" * 200 + "b": 25, "abcabc": 125, "abcabd": 25, "abcabe": 25, "abcab\u00ff": 5})
    return made


@pytest.mark.parametrize("shelf, tile", [(variants.SHELF, variants.TILE), (7, 3)])
def test_group_variants(spark, counts, shelf, tile):
    let_workers_import(spark)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    found = variants.group_variants(words, shelf=shelf, tile=tile).collect()
    assert len(found) == len(counts)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == expected_rows(counts)


def test_roots_of_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)] + [("a", "w30")], "word string, form string")
    assert {r.word: r.root for r in variants.roots(forms).collect()} == {**{f"w{i}": "w37" for i in range(37)}, "a": "w37"}


def test_words_of_documents(spark):
    draw = random.Random(4)
    base = ["Thething", "été", "ÉTÉété", "ab×÷cd", "don't", "x" * 30, "Abcdefgh", "ÿÀþþþþ"]
    texts = [draw.choice([" ", "\n", "-"]).join(draw.choice(base) for _ in range(draw.randrange(90))) for _ in range(300)] + [None, ""]
    rows = [(i, t, "w") for i, t in enumerate(texts)] + [(None, "Thething " * 20, "w"), (5, texts[5], "w")]
    counted = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counted[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    expected = {w: n for w, n in counted.items() if len(w) >= 6 and n >= 5}
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert {r.word: r.n for r in variants.count_words(docs, change=variants.lost_letter(7)).collect()} == expected
    assert len(expected) > len(set(w.lower() for w in base))
    none = spark.createDataFrame([], "doc_id long, text string, word string")
    assert variants.group_variants(variants.count_words(none)).count() == 0


def test_shelf_bits():
    words = ["abcdef", "abcdeg", "abcdefg", "xbcdef"]
    one = np.ones(4, int)
    bits = variants.near_on_shelf(words, 0 * one, 0 * one, 6 * one, 0 * one)
    assert bits[:, 0].tolist() == [0b1110, 0b0101, 0b0011, 0b0001]
