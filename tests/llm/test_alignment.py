"""Alignment of two tokenizers against a brute force over token bytes."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from guestlens.llm import alignment
from guestlens.llm.catalog import QUERIES
from guestlens.llm.tables import stored
from tests.llm.fixtures import documents, rows, saved

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
GIVEN = "/root/testdata/sf0.001"

A = Tokenizer.from_file(BYTES)
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=PIECES)


def a_tokens(text):
    """Ids with their bytes: the library's offsets are into characters, so bytes
    are taken from the byte-level signs."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in seen}
    for k, b in enumerate(b for b in range(256) if b not in seen):
        signs[chr(256 + k)] = b
    found = A.encode(" " + text, add_special_tokens=False)
    return [(i, bytes(signs[c] for c in t)) for i, t in zip(found.ids, found.tokens)]


def b_tokens(text):
    out = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        out.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    return out


def ranges(tokens):
    end, out = 0, []
    for i, raw in tokens:
        out.append((i, end, end + len(raw)))
        end += len(raw)
    return out


def brute(text):
    """(n_a, n_b, groups, links as a Counter of id pairs) from the definitions."""
    if not text:
        return 0, 0, "", Counter()
    a, b = a_tokens(text), b_tokens(text)
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return 0, 0, "", Counter()
    a, b = ranges(a), ranges(b)
    ends = sorted({e for *_, e in a} & {e for *_, e in b})
    groups = []
    for side in (a, b):
        own, k = [[] for _ in ends], 0
        for i, _, e in side:
            while e > ends[k]:
                k += 1
            own[k].append(str(i))
        groups.append([",".join(g) for g in own])
    groups = ["|".join(g) for g in zip(*groups)]
    links, j = Counter(), 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links[i, b[k][0]] += 1
            k += 1
    return len(a), len(b), ";".join(groups), links


def wanted(docs):
    found = [(d, brute(t)) for d, t in docs]
    count = Counter(p for _, (*_, links) in found for p in links)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (
            d, n_a, n_b, groups.count("|"), sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in links.items()), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for d, (n_a, n_b, groups, links) in found
    ]


def order(values):
    return sorted(map(tuple, values), key=repr)


@pytest.mark.parametrize("case", ["fixture", "given", "empty"])
def test_query_equals_brute_force(spark, tmp_path, case):
    if case == "given":
        folder = GIVEN
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{GIVEN}/documents.parquet").collect()]
    else:
        values = [] if case == "empty" else None
        folder = saved(documents(spark, values), tmp_path)
        docs = [] if case == "empty" else [r[:2] for r in rows()]
    found = QUERIES["op13_align_tokenizers"](spark, folder)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == names
    assert order(found.collect()) == order(wanted(docs))


@pytest.mark.parametrize("hot", [0, 1, 50, 1 << 19])
def test_rare_pairs_are_counted_the_same(spark, hot):
    found = stored(alignment.alignments(documents(spark), BYTES, PIECES).drop("groups"), "found")
    sums = alignment.scored(found, hot).collect()
    scores = sorted((r.n_links, r.n_best, r.count_sum) for r in sums)
    assert scores == sorted(w[4:7] for w in wanted([r[:2] for r in rows()]) if w[4])


def test_clashing_columns_are_ignored(spark):
    docs = documents(spark)
    for name in ("row", "pairs", "times", "n_a", "n", "pair", "groups", "best"):
        docs = docs.withColumn(name, docs.lang)
    wide = alignment.alignments(docs, BYTES, PIECES).where("row IS NOT NULL").drop("row")
    plain = alignment.alignments(documents(spark), BYTES, PIECES).where("row IS NOT NULL").drop("row")
    assert order(wide.collect()) == order(plain.collect())


PAIR = alignment.TokenPair(BYTES, PIECES)
ODD = [
    "▁", "a▁b", "<|endoftext|> <s>x</s>", "a  b   c\n\n d\t\te \n f", "x;\r\ny", " \xa0\n z", "\x1c a\x85 b", "\x00", "漢字🙂 é", "  ", "\n",
    "a  b", "ﬁ ½ ²", "don't  we'll", "<0x0A> <unk>", "é ▁", " a", "a ", "a\r b", "\r\r\n",
]


def one(text):
    found = alignment.align(PAIR, [text])
    pairs = zip(found["pairs"][0].as_py(), found["times"][0].as_py())
    links = Counter({(p >> 32, p & 0xFFFFFFFF): n for p, n in pairs})
    return found["n_a"][0].as_py(), found["n_b"][0].as_py(), found["groups"][0].as_py(), links


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert one(text) == brute(text)


def test_odd_texts_together():
    found = alignment.align(PAIR, ODD)
    assert found["groups"].to_pylist() == [brute(t)[2] for t in ODD]


ANY = st.text(st.one_of(st.sampled_from(" \n\t\r\xa0▁.,;'a1é漢"), st.characters(codec="utf-8")), min_size=1)


@settings(max_examples=400, deadline=None)
@given(ANY)
def test_any_text(text):
    assert "".join(alignment.stretches(text)) == text
    assert one(text) == brute(text)


def test_stretches_are_cut_where_nothing_crosses():
    assert PAIR.cuts
    assert alignment.stretches(" a b\nc\r\nd  e ") == [" a", " b", "\nc\r\nd", "  e "]
    assert alignment.stretches(" \n ") == [" \n "]


def test_a_worker_that_forgets_gives_the_same(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    pair = alignment.TokenPair(BYTES, PIECES)
    texts = [r[1] for r in rows() if r[1]][:12]
    assert alignment.align(pair, texts)["groups"].to_pylist() == [brute(t)[2] for t in texts]
