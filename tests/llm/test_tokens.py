"""Token ids, bit packing, sequence packing and word-piece counts."""

import io
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from guestlens.llm import bitpack, packing, tokens, wordpieces
from guestlens.llm.catalog import QUERIES
from guestlens.llm.tables import ship
from guestlens.llm.tokens import Encoder
from tests.llm.fixtures import documents, rows, saved, words

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module", params=["fixture", "given", "empty"])
def case(request, spark, tmp_path_factory, tokenizer):
    if request.param == "given":
        table = spark.read.parquet(f"{FOLDER}/documents.parquet")
        docs, folder = [(r.doc_id, r.text) for r in table.collect()], FOLDER
    else:
        values = [] if request.param == "empty" else None
        folder = saved(documents(spark, values), tmp_path_factory.mktemp("docs"))
        docs = [] if values == [] else [r[:2] for r in rows()]
    return folder, [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in docs]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


ODD = ["<|endoftext|> x", "a<|startoftext|>b", "it's don't 'll", "é é", "İ ſ K ß ﬁ", "a\x1cb\x85c d", "٣ ² 漢字🙂!!", "x.y,z;", "''' a' 's"]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library(tokenizer, text):
    wanted = np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert Encoder(PATH).encode([text.encode()]) == [wanted]


ENCODER = Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_equal_the_library_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    wanted = np.asarray(ENCODER.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ENCODER.encode([text.encode()]) == [wanted]


def test_words_set_aside_and_forgotten_give_the_same_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 12)
    monkeypatch.setattr(tokens, "AT_ONCE", 200)
    chance = random.Random(5)
    some = [w + m for w in ("alpha", "Bêta", "gamma7", "don't", "x", "ÉÉ") for m in ("", ".", "...", "!", "é")]
    texts = [None, "", " \n "] + [" ".join(chance.choices(some, k=chance.randrange(60))) for _ in range(200)]
    encoder = Encoder(PATH)
    found = encoder.encode([t if t is None else t.encode() for t in texts])
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoder.aside and encoder.encode([]) == []


def test_other_tokenizers_are_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = Encoder(path)
    text = "Hello  world,\n this is."
    assert not encoder.by_words
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == Tokenizer.from_file(path).encode(text).ids


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_bits_round_trip(bits, ids):
    ids = np.array([i % 2**bits for i in ids], dtype="<u4")
    raw = bitpack.pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    assert bitpack.unpack(raw, bits, len(ids)).tolist() == ids.tolist()


def test_shard_gives_any_stretch():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 49_408, 30_000).astype("<u4")
    ends = np.array([0, 5, 5, 9_000, 30_000])
    raw = b"".join(bitpack.shard_bytes([3, None, 4, 9, 10], ends, ids, 16))
    shard = bitpack.Shard(io.BytesIO(raw))
    assert shard.doc_ids == [3, None, 4, 9, 10]
    assert [shard.document(k).tolist() for k in range(5)] == [ids[a:b].tolist() for a, b in zip([0, *ends], ends)]
    for start, end in [(0, 1), (4095, 4097), (29_999, 30_000), (7, 7), (0, 30_000)]:
        assert shard.ids(start, end).tolist() == ids[start:end].tolist()


def test_packed_ids(spark, case):
    folder, docs = case
    found = sorted(QUERIES["op2_pack_token_ids"](spark, folder).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in found) == sorted((d or -1, len(i), crc(i)) for d, i in docs)
    assert [r.start for r in found] == [0, *itertools.accumulate(r.n_tokens for r in found)][: len(found)]
    order = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert order == sorted(order)


def test_packed_sequences(spark, case):
    folder, docs = case
    found = QUERIES["op7_pack_sequences"](spark, folder).collect()
    wanted = [(d or -1, k, s, len(i[s : s + 4096]), crc(i[s : s + 4096])) for d, i in docs for k, s in enumerate(range(0, len(i), 4096))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(wanted)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        placed.sort()
        assert [o for o, _ in placed] == [0, *itertools.accumulate(n for _, n in placed)][: len(placed)]
        assert sum(n for _, n in placed) <= 4096
    assert len(sequences) <= -(-sum(w[3] for w in wanted) // 4096) + 1


def fewest(lengths, room):
    """Brute force: each piece into each sequence that has space."""
    best = len(lengths)

    def place(k, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if k == len(lengths):
            best = len(spaces)
            return
        for i in range(len(spaces)):
            if spaces[i] >= lengths[k] and spaces[i] not in spaces[:i]:
                place(k + 1, [*spaces[:i], spaces[i] - lengths[k], *spaces[i + 1 :]])
        place(k + 1, [*spaces, room - lengths[k]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=11))
def test_fewest_sequences(lengths):
    counts = np.bincount(lengths, minlength=21)
    solution = packing.completed(counts, 20)
    used = np.zeros(21, dtype=int)
    for n, filling in solution:
        assert sum(length * many for length, many in filling) <= 20
        for length, many in filling:
            used[length] += n * many
    assert used.tolist() == counts.tolist()
    assert sum(n for n, _ in solution) == fewest(lengths, 20)


def test_large_tables_of_lengths_pack_tightly():
    rng = np.random.default_rng(1)
    lengths = np.minimum(4096, rng.lognormal(6, 1.2, 300_000).astype(int) + 1)
    counts = np.bincount(lengths, minlength=4097)
    used = sum(n for n, _ in packing.completed(counts, 4096))
    assert used <= -(-int(lengths.sum()) // 4096) + 2


def triplets(n):
    """Lengths cut from full sequences of three pieces each."""
    rng, lengths = random.Random(n), []
    for _ in range(n):
        a = rng.randrange(1024, 2048)
        b = rng.randrange((4096 - a) // 3, (4096 - a) * 2 // 3)
        lengths += [a, b, 4096 - a - b]
    return np.bincount(lengths, minlength=4097)


@pytest.mark.parametrize("n,most", [(30, 30), (200, 202), (1000, 1015)])
def test_pieces_that_would_fill_all_sequences(n, most):
    counts = triplets(n)
    solution = packing.completed(counts, 4096)
    used = np.zeros(4097, dtype=int)
    for k, filling in solution:
        assert sum(length * many for length, many in filling) <= 4096
        for length, many in filling:
            used[length] += k * many
    assert (used == counts).all()
    assert n <= sum(k for k, _ in solution) <= most < sum(k for k, _ in packing.best_fit(counts, 4096))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9), st.integers(0, 20))
def test_fillings_hold_the_best_one(lengths, most):
    """Against all ways to choose pieces beside a largest one."""
    counts, largest = np.bincount(lengths, minlength=21), max(lengths)
    rest = sorted(lengths)[:-1]
    sums = {largest + sum(rest[i] for i in range(len(rest)) if mask >> i & 1) for mask in range(1 << len(rest))}
    least = min((20 - s for s in sums if s <= 20), default=None)
    found = packing.fillings(counts, 20, most)
    assert bool(found) == (least <= most)
    if found:
        assert 20 - sum(x * many for x, many in found[0]) == least
    assert all(dict(f)[largest] and all(many <= counts[x] for x, many in f) for f in found)


def greedy(word, vocabulary, prefix):
    rest, n = prefix + word, 0
    while rest:
        size = next((k for k in range(len(rest), 0, -1) if rest[:k] in vocabulary), 0)
        if not size:
            return 1
        rest, n = rest[size:], n + 1
    return n


PIECES = st.lists(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=14)


@settings(max_examples=400, deadline=None)
@given(PIECES, st.binary(max_size=14).map(lambda b: bytes(x % 3 + 97 for x in b)), st.sampled_from([b"", b"_"]))
def test_longest_match_equals_greedy(pieces, word, prefix):
    pieces = pieces + [prefix + p for p in pieces[::2]] + ([prefix] if prefix else [])
    assert wordpieces.LongestMatch(pieces, prefix).count(word) == greedy(word, set(pieces), prefix)


def test_word_pieces(spark, case):
    folder, _ = case
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    usual = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    vocabulary = {model.id_to_piece(i).encode() for i in usual} | {bytes([b]) for b in range(256)}
    found = QUERIES["op4_count_word_pieces"](spark, folder).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    known = {}

    def count(word):
        if word not in known:
            known[word] = greedy(word.encode(), vocabulary, "▁".encode())
        return known[word]

    wanted = [(d or -1, len(words(t)), sum(map(count, words(t)))) for d, t in texts]
    assert sorted((r.doc_id or -1, r.n_words, r.n_pieces) for r in found) == sorted(wanted)


def test_the_package_is_shipped_once(spark):
    ship(spark)
    ship(spark)
