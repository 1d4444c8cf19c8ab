"""Tokens of two tokenizers aligned, against the libraries' own ids walked one by one."""

import bisect
import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelloom.llm import alignment
from panelloom.llm.catalog import QUERIES, tokenizer_path
from panelloom.llm.pieces import Pieces

DIR = "/root/testdata/sf0.001"
MODEL = tokenizer_path("piece_bpe_32k.model")
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (None, "x"), (1, None), (2, ""), (3, "▁a b"), (4, "<|endoftext|> <s> </s> <0x41>"), (5, " \n\n  a  b\t"), (6, "日本語 😀 " * 900),
    (7, "x" * 4000), (7, "x" * 4000), (8, "a ▁ " * 900), (9, "hello world, it's " * 300), (10, " " * 5000), (11, "ab  c\x00d\x85e"),
]


@pytest.fixture(scope="module")
def given():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read(), Pieces.load(MODEL)


@pytest.fixture(scope="module")
def plain(given):
    """The contract, a token at a time, from the libraries."""
    a = Tokenizer.from_str(given[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    shown = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    of_a = lambda i: bytes(byte[c] for c in a.id_to_token(i))

    def of_b(i):
        return bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def aligned(rows):
        docs, counts = [], collections.Counter()
        for doc_id, text in rows:
            ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
            raw = [[f(i) for i in x] for f, x in zip((of_a, of_b), ids, strict=True)]
            if text and any(b"".join(r) != (" " + text).encode() for r in raw):
                ids, raw = [[], []], [[], []]
            ends = [np.cumsum([len(t) for t in r]).tolist() for r in raw]
            at = [dict(zip(e, i, strict=True)) for e, i in zip(ends, ids, strict=True)]
            cuts = sorted(set(ends[0]) & set(ends[1]))
            links = [(at[0][c], at[1][c]) for c in cuts]
            counts.update(links)
            groups, low = [], [0, 0]
            for c in cuts:
                upto = [bisect.bisect(e, c) for e in ends]
                groups.append("|".join(",".join(map(str, i[x:y])) for i, x, y in zip(ids, low, upto, strict=True)))
                low = upto
            docs.append((doc_id, ids, groups, links))
        most = collections.Counter()
        for (_, right), n in counts.items():
            most[right] = max(most[right], n)
        return sorted(
            [
                (i, len(ids[0]), len(ids[1]), len(g), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                 hashlib.sha256(";".join(g).encode()).hexdigest() if ids[0] else "")
                for i, ids, g, links in docs
            ],
            key=str,
        )

    return aligned


@pytest.mark.parametrize(("long_bytes", "range_bytes"), [(1 << 20, 1 << 16), (700, 90)])
def test_alignment_is_the_plain_one(spark, given, plain, long_bytes, range_bytes):
    """Whether or not texts are put together from fragments; with more ranges than compose at once."""
    docs = spark.createDataFrame([(i, t, t, 1) for i, t in ODD], "doc_id long, text string, span string, UID int").repartition(3)
    found = alignment.align(docs, *given, long_bytes=long_bytes, range_bytes=range_bytes)
    got = alignment.score(found)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=str) == plain(ODD)
    assert (found.ranges.count() > 2 * alignment.FAN) == (long_bytes < 1000)


def test_alignment_of_nothing(spark, given):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.score(alignment.align(docs, *given)).collect() == []


def test_alignment_query(spark, plain):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_token_alignment"](spark, DIR)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=str) == plain([tuple(r) for r in docs])


def test_composition_is_associative():
    """Any bracketing of the same ranges gives the same open ends and the same groups."""
    rng = random.Random(1)

    def ids():
        return tuple(np.array([rng.randrange(9) for _ in range(rng.randrange(3))], dtype=np.int32) for _ in range(2))

    def told(found):
        fragment, seams = found
        listed = lambda pair: tuple(x.tolist() for x in pair)
        return fragment.cuts, fragment.first if fragment.cuts else 0, listed(fragment.head), listed(fragment.tail), sorted((at, *listed(g)) for at, g in seams)

    def bracketed(leaves):
        if len(leaves) == 1:
            return leaves[0], []
        k = rng.randrange(1, len(leaves))
        (x, one), (y, two) = bracketed(leaves[:k]), bracketed(leaves[k:])
        both, more = alignment.compose(x, y)
        return both, one + two + more

    for _ in range(200):
        leaves = []
        for place in range(rng.randrange(1, 9)):
            cuts = rng.randrange(3)
            leaves.append(alignment.Fragment(cuts, place, ids(), ids() if cuts else alignment._no_ids()))
        assert told(bracketed(leaves)) == told(bracketed(leaves))
        none = alignment.Fragment()
        assert told(alignment.compose(none, leaves[0])) == told((leaves[0], [])) == told(alignment.compose(leaves[0], none))


def test_spans_are_cut_between_words():
    data = (" ab c  d\te é f g," + " word" * 50).encode()
    cuts = alignment.span_cuts(data, 10)
    assert cuts[0] == 0 and len(cuts) > 10
    assert all(data[c : c + 1] == b" " and data[c - 1] > 32 and data[c + 1] > 32 for c in cuts[1:])
    assert alignment.span_cuts(b" " * 100, 10) == [0] and alignment.span_cuts(b" ", 10) == [0]


def test_pairs_are_bounded_by_the_vocabularies(given):
    raw = alignment.ByteBpe(given[0]).raw
    assert 200_000 < alignment.possible_pairs(raw, given[1].raw) < 400_000
    assert alignment.possible_pairs([b"ab", b"b", b"c"], [b"b", b"xab", b"d", b"b"]) == 6


def test_long_runs_are_encoded_as_the_library_does(given):
    import pyarrow as pa

    rng = random.Random(1)
    texts = [" " * 30_000, " " * 5000 + "a" + " " * 17, "".join(rng.choice("abcdefghij") for _ in range(5000)), "".join(rng.choice("ab=-") for _ in range(3000)), "-" * 3001]
    assert given[1].encode(pa.array(texts)).to_pylist() == sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(texts)
