"""Language identification: held-out accuracy and the model by hand."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
import regex

from guestlens.llm import language
from guestlens.llm.catalog import QUERIES
from tests.llm.fixtures import documents, rows, saved

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op8_identify_language"](spark, FOLDER).collect()
    truth = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    right = [r.lang_pred == truth[r.doc_id].lang for r in held]
    assert sum(right) >= 0.98 * len(right) > 100
    assert all(0 <= r.score <= 1 for r in found)


@pytest.mark.parametrize("values", [None, []])
def test_edge_rows(spark, tmp_path, values):
    folder = saved(documents(spark, values), tmp_path)
    found = QUERIES["op8_identify_language"](spark, folder).collect()
    texts = [] if values == [] else [(r[0], r[1]) for r in rows()]
    assert sorted((r.doc_id or -1) for r in found) == sorted((d or -1) for d, _ in texts)
    for r in found:
        texts_of = [t for d, t in texts if d == r.doc_id]
        if not any(any(c.isalpha() for c in t or "") for t in texts_of):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif len(texts_of) == 1:
            assert r.lang_pred in ("en", "fr")


def test_scores_by_hand():
    model = language.Model.of([("x", 0, "ab", 3), ("y", 0, "ab", 1), ("x", 1, "a", 2), ("y", 1, "c", 2), ("x", 2, "ca", 5)])
    assert model.score("ab") == pytest.approx([math.log(3.5 / 4), math.log(1.5 / 2)])
    # " ca ": the 2-gram "ca" first, then at "a" only the letter is known.
    two = [math.log(5.5 / 6) + 2 * language.BACKOFF, math.log(0.5 / 1) + 2 * language.BACKOFF]
    one = [math.log(2.5 / 3.5) + 3 * language.BACKOFF, math.log(0.5 / 3.5) + 3 * language.BACKOFF]
    assert model.score("ca") == pytest.approx([(a + b) / 2 for a, b in zip(two, one)])
    assert model.score("q") == pytest.approx([0, 0])


def test_the_label_and_id_play_no_part(spark):
    docs = documents(spark, [(i, f"the cat {i}", "en", None, None) for i in range(5)] + [(9, "le chat", "fr", None, None)])
    model = language.train(docs)
    other = documents(spark, [(77, "le chat", "en", "z", 3)])
    assert language.predicted(other, model, ["doc_id"]).first().lang_pred == "fr"


def test_repeated_texts_teach_once(spark):
    docs = documents(spark, [(i, "mot", "fr", None, None) for i in range(50)] + [(60, "mot word", "en", None, None)])
    model = language.train(docs)
    assert set(model.words.number) == {"mot", "word"}
    assert model.words.get("mot")[model.languages.index("fr")] == pytest.approx(math.log(1.5 / 2.5))


def brute(docs):
    """[(doc_id, held_out, lang_pred, score)] from the definitions, for so few texts
    that all of them are in the sample."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    taught = {(lang, text) for d, text, lang in docs if d is not None and not held(d) and lang is not None and text}
    split = lambda text: regex.findall(r"\p{L}+", (text or "").lower())
    counts = [defaultdict(Counter) for _ in range(language.LONGEST + 1)]
    for lang, text in taught:
        for word in split(text):
            counts[0][lang][word] += 1
            marked = f" {word} "
            for size in range(1, language.LONGEST + 1):
                for i in range(len(marked) - size + 1):
                    counts[size][lang][marked[i : i + size]] += 1
    languages = sorted({lang for kind in counts for lang in kind})
    logs = []
    for kind, own in enumerate(counts):
        most = language.WORDS if kind == 0 else language.GRAMS
        kept = {g for c in own.values() for g in sorted(c, key=lambda g: (-c[g], g.encode()))[:most]}
        total = [sum(own[x][g] for g in kept) + language.SMOOTH * (len(kept) + 1) for x in languages]
        logs.append({g: [math.log((own[x][g] + language.SMOOTH) / t) for x, t in zip(languages, total)] for g in kept})

    def score(word):
        if word in logs[0]:
            return logs[0][word]
        marked, found = f" {word} ", []
        for i in range(len(marked) - 1):
            for size in range(min(language.LONGEST, len(marked) - i), 0, -1):
                row = logs[size].get(marked[i : i + size])
                if row is not None:
                    found.append([x + language.BACKOFF * (language.LONGEST - size) for x in row])
                    break
        return [sum(x) / len(found) for x in zip(*found)] if found else [0.0] * len(languages)

    out = []
    for d, text, _ in docs:
        total = [sum(x) for x in zip(*map(score, split(text)))]
        if not total or not languages:
            out.append((d, held(d), "und", 0.0))
            continue
        best = max(range(len(languages)), key=lambda k: (total[k], -k))
        out.append((d, held(d), languages[best], 1 / sum(math.exp(x - total[best]) for x in total)))
    return out


def test_rows_in_full_equal_those_made_of_counts(monkeypatch):
    counts = [(name, kind, gram, n + len(gram)) for n, name in enumerate("xyz") for kind, gram in ((0, "ab"), (1, "a"), (2, "c" + name))]
    full = language.Model.of(counts)
    monkeypatch.setattr(language, "FULL", 0)
    sparse = language.Model.of(counts)
    assert full.words.rows is not None and sparse.words.rows is None
    for word in ("ab", "ca", "cx", "q"):
        assert full.score(word).tolist() == sparse.score(word).tolist()


@pytest.mark.parametrize("case", ["given", "fixture"])
def test_query_equals_brute_force(spark, tmp_path, case):
    if case == "given":
        folder = "/root/testdata/sf0.001"
        docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    else:
        folder, docs = saved(documents(spark), tmp_path), [r[:3] for r in rows()]
    found = sorted((tuple(r) for r in QUERIES["op8_identify_language"](spark, folder).select("doc_id", "held_out", "lang_pred", "score").collect()), key=repr)
    wanted = sorted(brute(docs), key=lambda r: repr(r[:3]))
    assert [f[:3] for f in sorted(found, key=lambda r: repr(r[:3]))] == [w[:3] for w in wanted]
    by_key = lambda values: sorted((r[0] is None, r[0] or 0, r[2], round(r[3], 6)) for r in values)
    assert by_key(found) == by_key(wanted)


def test_no_label_is_left_out(spark):
    """140 labels, of which one has a third of all rows."""
    made = [(lang, " ".join("".join(random.Random(f"{lang}{i}{j}").choices(f"abc{chr(0x400 + lang)}", k=5)) for j in range(30))) for lang in range(140) for i in range(6)]
    made += [(0, f"aaa bbb {chr(0x400)} x{i}") for i in range(400)]
    values = [(i, text, f"l{lang:03d}", None, None) for i, (lang, text) in enumerate(made)]
    model = language.train(documents(spark, values))
    assert len(model.languages) == 140
    found = language.predicted(documents(spark, values), model, ["doc_id"]).collect()
    assert all(r.lang_pred == values[r.doc_id][2] for r in found)


def test_the_sample_is_the_least_hashes_of_each_label(spark, monkeypatch):
    monkeypatch.setattr(language, "TEXTS", 7)
    docs = documents(spark, [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)}", ("a", "b")[i % 3 == 0], None, None) for i in range(300)])
    model = language.train(docs)
    hashed = docs.selectExpr("lang", "text", "xxhash64(text) AS h").collect()
    wanted = {r.text for name in "ab" for r in sorted((r for r in hashed if r.lang == name), key=lambda r: r.h)[:7]}
    assert set(model.words.number) == wanted


def test_clashing_columns(spark):
    docs = documents(spark)
    for name in ("place", "part", "cut", "n", "kind", "gram", "text_to_predict", "lang_pred", "score"):
        docs = docs.withColumn(name, docs.lang)
    plain = language.predicted(documents(spark), language.train(documents(spark)), ["doc_id"])
    found = language.predicted(docs, language.train(docs), ["doc_id"])
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
