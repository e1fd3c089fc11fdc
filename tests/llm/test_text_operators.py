"""BPE, rules, classifier, personal data: against brute force and the tokenizers library."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.conftest import ODD

from visitry.llm import bpe, classifier, pii, quality_rules
from visitry.llm.catalog import vocabulary_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary(vocabulary_path()))


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_bpe_equals_the_library(encoder, library):
    rnd = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "12", "é", "日本", "😀", "'s", "'LL", "<|endoftext|>", "!", "\x1c", "\x85", "　", "aaaa", "-", "\x00"]
    for _ in range(1500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        text += "".join(chr(rnd.choice([rnd.randint(1, 0x2FF), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(rnd.randint(0, 6)))
        assert encoder.encode(text) == ids_of(library, text), repr(text)


def test_bpe_classes_of_later_unicode(encoder, library):
    for low, high in bpe.LATER:
        for code in (low - 1, low, high, high + 1):
            if not 0xD800 <= code < 0xE000 and code < 0x110000:
                text = f"a{chr(code)}b {chr(code)}1{chr(code)}"
                assert encoder.encode(text) == ids_of(library, text), hex(code)


def test_bpe_long_piece(encoder, library):
    text = "ab" * 50_000
    assert encoder.encode(text) == ids_of(library, text)


def test_bpe_rows(make, library):
    docs = make([*ODD, (9, "Hello, world!<|endoftext|>")])
    rows = bpe.bpe_encode(docs, vocabulary_path()).collect()
    assert len(rows) == len(ODD) + 1
    texts = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(bpe.bpe_encode(docs, vocabulary_path()), vocabulary_path()).collect()}
    assert texts[9] == "Hello, world!<|endoftext|>" and texts[1] == "" and texts[5] == "é" * 40
    row = next(r for r in bpe.bpe_digest(docs, vocabulary_path()).collect() if r["doc_id"] == 9)
    assert row["ids_sha256"] == hashlib.sha256(ids_of(library, texts[9])).hexdigest() and row["n_tokens"] == 5
    assert bpe.bpe_digest(docs.limit(0), vocabulary_path()).collect() == []


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_rule_measures(make):
    rnd = random.Random(2)
    rows = list(ODD) + [(20 + k, "".join(rnd.choice(["a", "b", "É", " ", "\n", "#", "\x0b", "\x1c", "a b c d e ", "x\n"]) for _ in range(rnd.randint(1, 300)))) for k in range(60)]
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.judge_quality(make(rows)).collect())
    assert got == Counter((i, *measured(t)) for i, t in rows)


def test_rule_votes_find_junk(make):
    rnd = random.Random(3)
    words = "the of and house tree river to in walked slowly towards morning light".split()
    good = [(k, " ".join(rnd.choice(words) + str(k * 97 + j) * (rnd.random() < 0.4) for j in range(80)) + ".") for k in range(150)]
    junk = [(1000 + k, " ".join(rnd.choice(words).upper() + "!!" for _ in range(80))) for k in range(10)]
    junk += [(2000 + k, " ".join(rnd.choice(words) + "***" + str(j) for j in range(80))) for k in range(10)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge_quality(make(good + junk)).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)
    assert quality_rules.judge_quality(make(good).limit(0)).collect() == []


def test_rules_stay_in_the_jvm(make):
    from pyspark.sql import functions as F

    plan = quality_rules.measures(make(ODD)).withColumn("p", F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange hashpartitioning", plan)


def test_classifier_on_held_out_documents(spark, make):
    rnd = random.Random(4)
    text = lambda good: " ".join(rnd.choice(["the", "of", "tree", "river", "light"]) + ("" if good else "**") + str(rnd.randint(0, 99)) for _ in range(rnd.randint(20, 90)))
    truth = {k: int(rnd.random() < 0.6) for k in range(400)}
    docs = make([*((k, text(q)) for k, q in truth.items()), (900, None), (901, "")])
    labels = spark.createDataFrame([*((k, q, 0) for k, q in truth.items()), (1, None, 0), (5000, 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in classifier.classify_quality(docs, labels).collect()}
    assert len(rows) == 402 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    held = [k for k in truth if rows[k]["held_out"]]
    assert all(rows[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k in rows)
    assert np.mean([rows[k]["predicted"] == truth[k] for k in held]) > 0.95
    kept = classifier.keep_quality(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, r in rows.items() if r["predicted"]}
    assert {r["score"] for r in classifier.classify_quality(docs, labels.limit(0)).collect()} == {0.5}
    # flipping held-out labels changes no score
    flipped = spark.createDataFrame([(k, 1 - q if rows[k]["held_out"] else q, 0) for k, q in truth.items()], "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in classifier.classify_quality(docs, flipped).collect()}
    assert all(abs(again[k] - r["score"]) < 1e-6 for k, r in rows.items())


def test_isotonic_pools():
    assert classifier.rising(np.array([1.0, 1, 2]), np.array([0.5, 0.1, 0.9])).tolist() == pytest.approx([0.3, 0.3, 0.9])


def plain_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub(r"\D", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1]))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"\D", "", m.group())) <= 15]


def test_base_spans_equal_plain_expressions():
    rnd = random.Random(5)
    parts = ["a", "b@", "@", ".", "c.d", "1", "22", "1.2.3.4", "256.1.1.1", ".5", " ", "-", "+1", "+", "(555)", "4111111111111111", "4111 1111 1111 1111", "x", "%", "é"]
    for _ in range(4000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == plain_spans(t), repr(t)


def test_base_spans_of_long_runs():
    for t in ("a" * 300_000 + " @", "1" * 300_000, "a@" * 50_000, "1." * 100_000, "+1" + " " * 200_000):
        pii.base_spans(t)
    assert pii.base_spans("1.2.3." + "0" * 5_000 + "7") == [(1, 0, 5_007)] and pii.base_spans("1.2.3." + "9" * 5_000) == []


@pytest.mark.parametrize("at_once", [200_000, 1])
def test_patterns_find_unseen_identifiers(make, monkeypatch, at_once):
    monkeypatch.setattr(pii, "PATTERNS_AT_ONCE", at_once)
    rows = [(k, f"please write to name{k}@mail.com today now") for k in range(5)] + [(k, "please write to name0@mail.com today now") for k in range(10, 30)]
    rows += [(50, "please write to joe@host today"), (51, "please write to 12:30pm today"), *ODD]
    found = pii.span_digest(pii.extract_identifiers(make(rows))).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    assert by[50]["spans"] == "email:16:24" and by[50]["n_email"] == 0 and by[51]["spans"] == "" and by[0]["n_email"] == 1
    texts = {r["doc_id"]: r["text"] for r in pii.redact(make(rows)).collect()}
    assert texts[50] == "please write to <EMAIL> today" and texts[1] is None and texts[51] == rows[26][1]


def test_copies_are_no_support(make):
    rows = [(k, "please write to name0@mail.com today now") for k in range(20)] + [(50, "please write to joe@host today")]
    assert pii.trusted_patterns(pii.find_marks(make(rows))).count() == 0
    assert pii.span_digest(pii.extract_identifiers(make(rows).limit(0))).collect() == []
