"""Token alignment against a plain version that encodes whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from windrow.llm import alignment, queries
from windrow.llm.arrow import let_workers_import

SCHEMA = "doc_id long, text string, block long, n_a string, docs string"


def encoded(texts):
    """For each text the ids of A and B, cut into groups; None if the bytes do not come back."""
    a_library = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_TOKENIZER)
    symbol = alignment.byte_of_symbol()
    out = []
    for text in texts:
        if not text:
            out.append([])
            continue
        a = a_library.encode(" " + text, add_special_tokens=False).ids
        b = b_library.encode(text)
        a_bytes = [bytes(symbol[c] for c in a_library.id_to_token(i)) for i in a]
        b_bytes = []
        for i in b:
            piece = b_library.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if b_library.is_byte(i) else piece.replace("▁", " ").encode())
        if not b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
            out.append([])
            continue
        ends = [set(np.cumsum([len(x) for x in y]).tolist()) for y in (a_bytes, b_bytes)]
        common = sorted(ends[0] & ends[1])
        groups, at = [], [0, 0]
        positions = [np.cumsum([len(x) for x in y]).tolist() for y in (a_bytes, b_bytes)]
        for stop in common:
            one = []
            for side, ids in ((0, a), (1, b)):
                first = at[side]
                at[side] = positions[side].index(stop) + 1
                one.append(ids[first : at[side]])
            groups.append(one)
        out.append(groups)
    return out


def expected_rows(ids, texts):
    aligned = encoded(texts)
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in aligned]
    docs = Counter(pair for one in links for pair in one)
    highest = {}
    for (a, _), n in docs.items():
        highest[a] = max(highest.get(a, 0), n)
    rows = Counter()
    for name, groups, one in zip(ids, aligned, links):
        described = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows[
            name,
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            sum(one.values()),
            sum(n for p, n in one.items() if docs[p] == highest[p[0]]),
            sum(n * docs[p] for p, n in one.items()),
            hashlib.sha256(described.encode()).hexdigest() if groups else "",
        ] += 1
    return rows, docs, sum(links, Counter())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(12)
    words = "the of don't thing Onsh été naïve 1234567 x=1 <|endoftext|> <s> <0x0A> </s> ▁ a▁b é \u0301 日本語 😀😀 fi \r \x00z \xa0 \u2003 \u2581x ...!! \x1c \x85".split(" ")
    gaps = [" "] * 12 + ["  ", "   ", "\n", " \n", "\n ", "\t", "", "\n\n  ", "\xa0 ", " \u3000 "]

    def text(n):
        return "".join(draw.choice(words) + draw.choice(gaps) for _ in range(n))

    texts = [text(draw.randrange(60)) for _ in range(150)]
    texts += ["", None, " ", "  ", "a", " a", "a ", "\n", " \n x", "the " * 3000, "aaaa" * 3000, "ab" * 5000 + " ", "<|endoftext|>", "x <|endoftext|>  y", "ﬁ ﬁ"]
    texts += ["".join(chr(draw.choice([32, 32, 10, 65, 97, 98, 0xE9, 0x2581, 0x3042, 0x1F600, 0xA0, 9, 0x301])) for _ in range(40)) for _ in range(200)]
    found = [(i, t, 1, "x", "y") for i, t in enumerate(texts)]
    return found + [found[3], (None, texts[4], 1, "x", "y"), (None, None, 1, "x", "y"), (3, "another text", 1, "x", "y")]


@pytest.mark.parametrize("block_links", [alignment.BLOCK_LINKS, 50])
def test_scores(spark, rows, block_links):
    let_workers_import(spark)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = alignment.build_index(docs, queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER, block_links=block_links, keep_groups=True)
    expected, pair_docs, pair_links = expected_rows([r[0] for r in rows], [r[1] for r in rows])
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = alignment.score_documents(index).collect()
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == expected
    assert all((hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") == r.groups_sha256 for r in got)
    pairs = {(r.a, r.b): r for r in index.pairs().collect()}
    assert {p: r.n_docs for p, r in pairs.items()} == pair_docs
    assert {p: r.n_links for p, r in pairs.items()} == pair_links


def test_no_documents(spark):
    let_workers_import(spark)
    index = alignment.build_index(spark.createDataFrame([], SCHEMA), queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER)
    assert alignment.score_documents(index).count() == 0
    blank = alignment.build_index(spark.createDataFrame([(1, None)], "doc_id long, text string"), queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER)
    assert [tuple(r)[:7] for r in alignment.score_documents(blank).collect()] == [(1, 0, 0, 0, 0, 0, 0)]


def test_store_is_bounded(rows):
    texts = [r[1] for r in rows if r[1]]
    small, large = (alignment.Aligner(queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER, limit) for limit in (20, 1 << 18))
    for i in range(0, len(texts), 10):
        part = texts[i : i + 10]
        one, other = alignment.Block(), alignment.Block()
        assert alignment._described(small, part, one, True)["groups"] == alignment._described(large, part, other, True)["groups"]
        assert len(small.known) <= 20 + sum(len(t.split(" ")) for t in part)


def test_bitmaps_of_both_kinds():
    numbers = [np.arange(0, 65536, 3), np.array([5, 9, 65535]), np.arange(4096), np.arange(4097)]
    counts = np.array([len(x) for x in numbers])
    found, rows = alignment.members(alignment.containers(np.concatenate(numbers), counts), counts)
    assert found.tolist() == np.concatenate(numbers).tolist() and rows.tolist() == np.repeat(np.arange(4), counts).tolist()
    block = alignment.Block()
    block.add(np.repeat(np.array([7 << 32 | 3, 1 << 32 | 2]), [13, 1]), np.full(14, 4))
    block.add(np.array([7 << 32 | 3]), 9, np.array([1 << 20]))
    planes = {(a, b, plane): alignment.members(bits.slice(i, 1), counts[i : i + 1])[0].tolist() for a_, b_, plane, counts, bits in block.planes() for i, (a, b) in enumerate(zip(a_.tolist(), b_.tolist()))}
    times = Counter()
    for (a, b, plane), docs in planes.items():
        for d in docs:
            times[a, b, d] += 1 << max(plane - 1, 0)
    assert times == {(7, 3, 4): 13, (7, 3, 9): 1 << 20, (1, 2, 4): 1}
