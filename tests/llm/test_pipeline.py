"""Each pipeline stage against brute force on its own input, and the whole run."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from guestlens.llm import mixing, quality, secrets
from tests.llm.fixtures import documents, rows, saved, wide, words
from tests.llm.test_native import counted, filled
from tests.llm.test_neardups import grouped
from tests.llm.test_tokens import crc

GIVEN = "/root/testdata/sf0.001"
CLASSES = ["[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[!-/:-@\[-`{-~\x00-\x08\x0E-\x1F\x7F]", r"[^\x00-\x7F]"]


def distance(p, q):
    x, y = [v / sum(p) for v in p], [v / sum(q) for v in q]
    kl = lambda a, b: sum(i * math.log2(2 * i / (i + j)) for i, j in zip(a, b) if i)
    return math.sqrt(max(0, (kl(x, y) + kl(y, x)) / 2))


def good(docs):
    """The documents that the rules keep."""
    classes = {d: [len(re.findall(c, d[1] or "")) for c in CLASSES] for d in set(docs)}
    chars, tally = {}, {}
    for text, lang in {(d[1], d[2]) for d in docs if d[1] is not None and d[2] is not None}:
        if not counted(text)[-1]:
            chars[lang] = [a + b for a, b in zip(chars.get(lang, [0] * 6), [len(re.findall(c, text)) for c in CLASSES])]
            tally.setdefault(lang, Counter()).update(words(text.lower()))
    known = set(tally)
    top = {k: sorted(t, key=lambda w: (-t[w], w.encode()))[: quality.COMMON] for k, t in tally.items()}
    out = []
    for d in docs:
        n, *_, failed = counted(d[1])
        keep = not failed
        if keep and d[2] in known and len(d[1]) >= quality.LEAST_CHARS_JUDGED:
            keep = distance(classes[d], chars[d[2]]) <= quality.MOST_CHAR_DISTANCE
        if keep and d[2] in known and n >= quality.LEAST_WORDS_JUDGED:
            histogram = lambda t: [t[w] for w in top[d[2]]] + [sum(t.values()) - sum(t[w] for w in top[d[2]])]
            keep = distance(histogram(Counter(words(d[1].lower()))), histogram(tally[d[2]])) <= quality.MOST_WORD_DISTANCE
        if keep:
            out.append(d)
    return out


def mixed(docs):
    """The documents as often as the mix holds them; rows that repeat go together."""
    sizes, groups = defaultdict(int), defaultdict(list)
    for d in docs:
        sizes[d[3]] += len(words(d[1]))
        text = d[1] or ""
        digest = int(hashlib.md5(f"{'' if d[0] is None else d[0]}:{text}".encode()).hexdigest()[:12], 16)
        weight = 0.1 + 0.9 * len(re.sub(mixing.POOR, "", text)) / max(1, len(text))
        groups[d[3], -math.log((digest + 0.5) / 2**48) / weight].append(d)
    target, before, out = filled(sizes), defaultdict(int), []
    for (source, _), own in sorted(groups.items(), key=lambda g: g[0][1]):
        inside = sum(len(words(d[1])) for d in own)
        epochs = math.floor(target[source] / sizes[source]) if sizes[source] else 0
        rest = target[source] - epochs * sizes[source]
        out += own * (epochs + (rest > 0 and 2 * before[source] + inside <= 2 * rest))
        before[source] += inside
    return out


@pytest.fixture(scope="module", params=["given", "wide", "empty"])
def staged(request, spark, tmp_path_factory):
    """Each stage's input and output rows."""
    if request.param == "given":
        docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    else:
        docs = wide(spark) if request.param == "wide" else documents(spark, [] if request.param == "empty" else None)
    out, folder = [], tmp_path_factory.mktemp("stages")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, GIVEN)
        result.write.parquet(f"{folder}/{k}")
        result = spark.read.parquet(f"{folder}/{k}")
        if k < 4:
            assert result.dtypes == docs.dtypes, name
        out.append(([tuple(r) for r in docs.collect()], result.collect()))
        docs = result
    return out


def same(found, wanted):
    return sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


def test_quality_stage(staged):
    docs, found = staged[0]
    assert same(found, good(docs))


def test_near_duplicate_stage(staged):
    docs, found = staged[1]
    groups = grouped([d[:2] for d in docs], 5, 80)
    wanted = Counter(component for _, n, component in groups if n and component is not None)
    assert Counter(r.doc_id for r in found if r.doc_id is not None and words(r.text)) == Counter(dict.fromkeys(wanted, 1))
    assert {tuple(r) for r in found} <= set(docs)


def test_secret_stage(staged):
    docs, found = staged[2]
    assert Counter(r.doc_id for r in found) == Counter(d[0] for d in docs)
    texts = defaultdict(set)
    for d in docs:
        texts[d[0]].add(d[1])
    for r in found:
        for _, pattern, group, least in secrets.BASE_KINDS:
            left = [m for m in re.finditer(pattern, r.text or "") if len(m[group]) >= least]
            assert not left
        assert r.text in texts[r.doc_id] or (secrets.MASK in r.text and r.n_chars == len(r.text))


def test_mix_stage(staged):
    docs, found = staged[3]
    assert same(found, mixed(docs))


def test_pack_stage(staged):
    docs, found = staged[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for d in docs:
        ids = [*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 1]
        wanted.update((d[0], k, len(ids[s : s + 4096]), crc(ids[s : s + 4096])) for k, s in enumerate(range(0, len(ids), 4096)))
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in found) == wanted
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in map(sorted, sequences.values()):
        assert [o for o, _ in placed] == [0, *itertools.accumulate(n for _, n in placed)][: len(placed)]
        assert sum(n for _, n in placed) <= 4096


def test_clean_documents_stay(spark):
    """No document of good quality goes but for copies and the mix."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    lost = docs.join(labels, "doc_id", "left_semi").join(kept, "doc_id", "left_anti").collect()
    assert all(counted(r.text)[-1] for r in lost)


def test_run_equals_the_stages(spark, tmp_path):
    folder = saved(documents(spark), tmp_path)
    found = corpus_pipeline.run(spark, folder).collect()
    assert found and {r.doc_id for r in found} <= {d[0] for d in rows()}
    assert np.array([r.length for r in found]).max() <= 4096
