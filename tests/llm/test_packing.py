import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wattmirror.llm import packing
from wattmirror.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, limit=1024):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    return by_sequence, by_doc


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(1)
    texts = ["", " ", "\n\n \t x", "don't we'll I'M", "<|endoftext|> a", "日本語 😀😀 ünï", "a" * 5000, " " * 3000, "١٢٣ 123 ⅷ",
             "​ x　y", "é̀", "\x00\x01"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 1000), rng.randrange(0x3000, 0xd000),
                                      rng.randrange(0x10000, 0x1ffff), 10, 32])) for _ in range(80)) for _ in range(400)]
    encode = packing.encoder(public_tokenizers.path(packing.RANKS)).encode_ordinary
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


END_OF_TEXT = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  y\n", "\n<|endoftext|>\n\n z",
               "<|endoftext|", "<<|endoftext|>>", "日本<|endoftext|>don't", "word " * 1500 + "<|endoftext|>" + " word" * 1500]


@pytest.fixture(scope="module")
def contract_tokenizer():
    """As it is loaded, without encode_special_tokens."""
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_added_tokens_are_those_of_the_tokenizer(contract_tokenizer):
    assert packing.ADDED == {t.content: i for i, t in contract_tokenizer.get_added_tokens_decoder().items()}


def test_literal_added_token(docs_of, contract_tokenizer):
    rng = random.Random(2)
    bits = ["<|endoftext|>", " ", "  ", "\n", "a", "'s", "12", "é", "😀", "<|", "|>", "endoftext"]
    texts = END_OF_TEXT + ["".join(rng.choice(bits) for _ in range(30)) for _ in range(300)]
    encode = packing.encode_text(public_tokenizers.path(packing.RANKS))
    for text in texts:
        assert encode(text) == contract_tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    rows = packing.pack(docs_of([(i, text) for i, text in enumerate(texts)])).collect()
    _, by_doc = check(rows)
    for i, text in enumerate(texts):
        ids = contract_tokenizer.encode(text, add_special_tokens=False).ids + [2]
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [x for r in own for x in r.ids] == ids
        assert [(r.start, r.length) for r in own] == packing.cut(len(ids))


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2047, 2048, 2049, 5000])
def test_cut(n):
    pieces = packing.cut(n)
    assert [s for s, _ in pieces] == [sum(length for _, length in pieces[:i]) for i in range(len(pieces))]
    assert sum(length for _, length in pieces) == n and all(length == 1024 for _, length in pieces[1:])


def plain_best_fit(lengths, limit):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(limit - x)
    return len(rooms)


def test_recipes_use_every_piece_once_and_beat_best_fit():
    rng = random.Random(4)
    for limit in (10, 64, 1024):
        for n in (1, 7, 300, 3000):
            lengths = Counter(min(limit, max(1, int(rng.expovariate(3 / limit)))) for _ in range(n))
            plan = packing.recipes(dict(lengths), limit)
            used = Counter()
            for count, own in plan:
                assert count > 0 and sum(own) <= limit
                for x in own:
                    used[x] += count
            assert used == lengths
            total = sum(c for c, _ in plan)
            assert -(-sum(x * c for x, c in lengths.items()) // limit) <= total
            assert total <= plain_best_fit(list(lengths.elements()), limit)
    assert packing.recipes({}) == []


def test_exact_complements_of_one_two_and_three():
    plan = packing._plan({600: 2, 424: 2, 700: 1, 200: 1, 124: 1, 500: 1, 300: 1, 150: 1, 74: 1}, 1024, 3)
    assert sorted(plan) == [(1, (500, 300, 150, 74)), (1, (700, 200, 124)), (2, (600, 424))]


def test_odd_rows(docs_of, odd_rows, clashes, tokenizer):
    docs = docs_of(odd_rows, clashes)
    rows = packing.pack(docs).collect()
    assert set(rows[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"}
    check(rows)
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        for k, (start, length) in enumerate(packing.cut(ids.size)):
            want[(doc_id, k, start, length, zlib.crc32(ids[start:start + length].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack(docs.limit(0)).count() == 0


def test_one_length_for_most_rows(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a b c', repeat('word ', int(id % 400))) AS text")
    rows = packing.pack(df, with_ids=False).collect()
    by_sequence, by_doc = check(rows)
    assert len(by_doc) == 3000
    assert len(by_sequence) <= 1.01 * sum(r.length for r in rows) / 1024 + 1


def test_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op8_pack_best_fit"](spark, sf).collect()
    by_sequence, by_doc = check(rows)
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        own = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == ids.size
        assert all(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    assert len(by_sequence) <= 1.02 * sum(r.length for r in rows) / 1024 + 1


@pytest.mark.parametrize("run", [" " * 1_000_000, " " * 2_000_000, "\n" * 1_000_000, "\n" * 2_000_000, "\t \n " * 300_000])
def test_long_white_space_has_the_tokenizers_ids(docs_of, contract_tokenizer, run):
    texts = [run, "a" + run + "b <|endoftext|> c", "x" + run]
    want = [contract_tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    rows = packing.pack(docs_of([(i, t) for i, t in enumerate(texts)])).collect()
    _, by_doc = check(rows)
    for i, ids in enumerate(want):
        assert [x for r in sorted(by_doc[i], key=lambda r: r.piece) for x in r.ids] == ids


@pytest.mark.parametrize("n", [49_999, 50_000, 50_001])
def test_white_space_around_the_bound(contract_tokenizer, n):
    encode = packing.encode_text(public_tokenizers.path(packing.RANKS))
    for text in (" " * n, "\n" * n + "x", "x " + "\r\n" * n):
        assert encode(text) == contract_tokenizer.encode(text, add_special_tokens=False).ids


def test_sums_of_three_and_four_are_spent_and_never_cost_a_sequence():
    """On lengths of documents (uniform first pieces, many short ones) sums are used, and best fit alone is no shorter."""
    rng = random.Random(6)
    for n in (200, 1500, 15_000, 60_000):
        lengths = Counter(rng.randint(1, 1024) if rng.random() < .5 else min(1024, 1 + int(rng.expovariate(1 / 150)))
                          for _ in range(n))
        plan = packing.recipes(dict(lengths))
        assert sum(c for c, _ in plan) <= plain_best_fit_counts(lengths)
        exact = Counter()
        for c, own in plan:
            exact[len(own)] += c if sum(own) == 1024 else 0
        if n >= 15_000:
            assert exact[2] > 0 and exact[3] > 100


def plain_best_fit_counts(lengths, limit=1024):
    """plain_best_fit with the rooms counted."""
    rooms, used = Counter(), 0
    for x in sorted(lengths, reverse=True):
        for _ in range(lengths[x]):
            room = next((r for r in range(x, limit) if rooms[r]), None)
            if room is None:
                used += 1
                rooms[limit - x] += 1
            else:
                rooms[room] -= 1
                rooms[room - x] += 1
    return used


def test_every_way_to_fill_a_gap_is_indexed():
    rng = random.Random(7)
    for _ in range(40):
        limit = 40
        lengths = np.array(sorted(rng.sample(range(1, limit), rng.randint(1, 20))))
        have = np.zeros(limit + 1, dtype=np.int64)
        have[lengths] = 1
        sums = packing.Sums(lengths, limit)
        for gap in range(1, limit):
            most = limit - gap
            ok = [x for x in lengths.tolist() if x <= most]
            assert list(sums.filling(have, gap, 1, most)) == [(x,) for x in ok if x == gap]
            assert sorted(sums.filling(have, gap, 2, most)) == sorted((x, gap - x) for x in ok if 2 * x >= gap and gap - x in ok)
            assert sorted(sums.filling(have, gap, 3, most)) == sorted(
                (x, y, gap - x - y) for x in ok for y in ok if x >= y >= gap - x - y and gap - x - y in ok)
