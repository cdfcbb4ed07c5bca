"""Language, toxicity, licenses, URLs and byte-level BPE."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.cases import CLASHING, N_CLASHING, ODD_IDS, ODD_TEXTS, documents, no_documents, odd_documents
from tierwell.llm import bpe, language, licenses, toxicity, urls
from tierwell.llm.common import Grams, text_slices

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def fold(i):
    return zlib.crc32(str(i).encode()) % 3


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (fold(r["doc_id"]) == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_by_brute_force(spark):
    texts = ["der die das und", "the and of that", "le la les des", "ein der und", "that the", "les le", "12 !", None, "Der und"] * 2
    docs = documents(spark, texts, langs=["de", "en", "fr", "de", "en", "fr", "en", None, None] * 2)
    grams, size = Grams(language.ORDERS, language.BITS), 1 << language.BITS

    def counts(t):
        out = np.zeros(size)
        for codes, rows in grams.blocks([t]):
            for _, slot in grams.hashed(codes, rows):
                np.add.at(out, slot, 1)
        return out

    train = [(r["text"], r["lang"]) for r in docs.collect() if fold(r["doc_id"]) != 1 and r["lang"] and r["text"] is not None]
    names = sorted({g for _, g in train})
    n = np.array([sum((counts(t) for t, g in train if g == name), np.zeros(size)) for name in names]) + language.SMOOTHING
    log_prob = np.log(n / n.sum(axis=1, keepdims=True))
    prior = np.log([sum(g == name for _, g in train) / len(train) for name in names])
    for r in language.identify(docs).collect():
        text = texts[r["doc_id"]]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            total = prior + log_prob @ counts(text)
            assert r["lang_pred"] == names[total.argmax()]
            assert r["score"] == pytest.approx(1 / np.exp(total - total.max()).sum(), abs=1e-4)


def test_language_odd_rows(spark):
    rows = language.identify(odd_documents(spark)).collect()
    assert len(rows) == len(ODD_TEXTS)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert language.identify(no_documents(spark)).collect() == []
    unlabelled = documents(spark, ["abc", None], langs=[None, None])
    assert {(r["lang_pred"], r["score"]) for r in language.identify(unlabelled).collect()} == {("und", 0.0)}
    kept = language.keep_known_language(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and 0 < kept.count() < len(ODD_TEXTS)


def test_grams_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = " ".join("abcdefg hijé".split() * 200)
    grams = Grams((1, 2, 3), 12)

    def all_slots():
        return sorted(s for c, r in grams.blocks([text, "x"]) for _, slots in grams.hashed(c, r) for s in slots.tolist())

    whole = all_slots()
    monkeypatch.setattr("tierwell.llm.common.BLOCK", 97)
    assert all_slots() == whole


def test_toxicity_finds_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    toxic, clean = ([r["score"] for r in held if r["toxic"] == y] for y in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.8
    assert np.mean([s >= 0.7 for s in clean]) < 0.03
    assert all(r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == (fold(r["doc_id"]) == 1) for r in rows)


def test_toxicity_learns_words_and_ignores_the_held_out_fold(spark):
    rng = random.Random(1)
    clean = [" ".join(rng.choice(["good", "day", "tree", "water", "house"]) for _ in range(12)) for _ in range(300)]
    texts = [t + (" gribblefrotz" if i % 3 == 0 else "") for i, t in enumerate(clean)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1, "x") for i in range(300)] + [(None, 1, 1, "x"), (9999, 1, 1, "x"), (4, None, 1, "x")], "doc_id long, toxic int, quality int, label string")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(documents(spark, texts), labels).collect()}
    assert all(found[i] == (i % 3 == 0) for i in range(300))
    held = labels.where("crc32(cast(doc_id as string)) % 3 = 1")
    assert {r["predicted"] for r in toxicity.score_toxicity(documents(spark, texts), held).collect()} == {0}


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (9, 0, 1), (7, 0, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity.score_toxicity(odd_documents(spark), labels).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(no_documents(spark), labels).collect() == []
    assert toxicity.keep_harmless(odd_documents(spark), labels.limit(0)).count() == len(ODD_TEXTS)


def base_scan(text):
    """The contract's words and phrases, position by position."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), found


LICENSE_TEXTS = [
    "MIT License MIT license, mit\nlicense! permit license",
    "Apache License, Version 2.0 and the GNU General Public License v3",
    "SPDX-License-Identifier: BSD-3-Clause",
    "Licensed under CC BY-NC 4.0.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "été license mit license日本 apache  license",
    "no such thing under the sun",
]


def test_license_base_places(spark):
    docs = documents(spark, LICENSE_TEXTS + ODD_TEXTS)
    texts = LICENSE_TEXTS + ODD_TEXTS
    for r in licenses.scan_licenses(docs).collect():
        n, found = base_scan(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (n, len(found))
        assert r["first_word"] == min((i for i, _ in found), default=None) and r["last_word"] == max((i for i, _ in found), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    tables = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    want = {r["doc_id"]: base_scan(r["text"]) for r in tables.collect()}
    assert all((r["n_words"], r["n_base"]) == (want[r["doc_id"]][0], len(want[r["doc_id"]][1])) for r in licenses.scan_licenses(tables).collect())
    assert licenses.scan_licenses(no_documents(spark)).collect() == []


def test_license_rules():
    scanner = licenses.Scanner()
    labels = [sorted({k[2] for k in scanner.scan(t).kept}) for t in LICENSE_TEXTS]
    assert labels[1] == ["apache-2.0", "gpl-3.0"]
    assert labels[2] == ["bsd-3-clause"]
    assert labels[3] == ["cc-by-nc-4.0"]
    assert labels[4] == ["mit"]
    assert labels[6] == []
    assert len(scanner.rules) > 300
    # A detection inside one of higher priority is suppressed.
    inner = scanner.scan("Licensed under the Apache License, Version 2.0").kept
    assert len(inner) == 1 and inner[0][:2] == (0, 8)


def test_keywords_never_hide_a_rule():
    every = [licenses.Rule(r.label, b" ", r.pattern, r.priority, r.weight, r.base) for r in licenses.rules()]
    gated, plain = licenses.Scanner(), licenses.Scanner(every)
    for t in LICENSE_TEXTS:
        assert {k[:4] for k in gated.scan(t).kept} == {k[:4] for k in plain.scan(t).kept}


def test_gates_never_hide_a_rule(monkeypatch):
    """Against a scanner without gates, the forms that need no "licen" first."""
    names = ("the GNU GPL v3", "MPL 2.0", "EPL 1.0", "the WTFPL", "CC BY 4.0")
    heads = ("Use of this file is subject to the terms of", "subject to the terms and conditions of", "subject to the conditions of", "under the terms of", "is licensed under", "released under", "SPDX-License-Identifier:", "dedicated to the public domain,")
    texts = [f"{head} {name}." for head in heads for name in names] + LICENSE_TEXTS
    texts += [key + " " + re.sub(r"\(\?:[^()]*\)\?|\.\{[^}]*\}\?", "", pattern) for _, key, pattern, _, _ in licenses.TEXTS]
    gated = [licenses.Scanner().scan(t) for t in texts]
    monkeypatch.setattr(licenses, "GATES", (b"",))
    assert gated == [licenses.Scanner().scan(t) for t in texts]
    assert [k[2] for s in gated[:5] for k in s.kept] == ["gpl-3.0", "mpl-2.0", "epl-1.0", "wtfpl", "cc-by-4.0"]


URLS = [
    ("http://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://Example.ORG/en/12?x=/es/", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://x.org/", "x.org", "/", "org/", "allow"),
    ("https://x.org", "x.org", "", None, None),
    ("ftp://shop.com/de/a#b", "shop.com", "/de/a", "com/de/", "block"),
    ("//shop.com/fr/", "", "", None, None),
    ("x://com/fr/y://z/de/", "com", "/fr/y://z/de/", "com/fr/", "allow"),
    ("http://dotcom/fr/", "dotcom", "/fr/", None, None),
    ("http://example.net?q", "example.net", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def pages(spark, found):
    return spark.createDataFrame([(i, u, "<html>", *["x"] * N_CLASHING) for i, u in enumerate(found)], f"page_id long, url string, html string, {CLASHING}")


def test_url_rules(spark):
    rows = urls.judge(pages(spark, [u[0] for u in URLS] * 2)).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        _, host, path, rule, verdict = URLS[r["page_id"] % len(URLS)]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert urls.judge(pages(spark, ["x"]).limit(0)).collect() == []
    assert {r["verdict"] for r in urls.judge(pages(spark, ["http://a.net/q", None])).collect()} == {"allow"}


def plain_url_scores(known, asked):
    """Log ratios by plain loops: exact counts of every context of 0 to 4 bytes."""
    follow, context = ({y: {} for y in (0, 1)} for _ in range(2))

    def places(text):
        raw = b"\0" * 4 + text.encode() + b"\0"
        return [raw[i - 4 : i + 1] for i in range(4, len(raw))]

    for text, side in known:
        for g in places(text):
            for k in range(1, 6):
                follow[side][g[-k:]] = follow[side].get(g[-k:], 0) + 1
                key = (k, g[-k:-1])
                context[side][key] = context[side].get(key, 0) + 1
    out = {}
    for text in asked:
        total = 0.0
        for g in places(text):
            for side, sign in ((0, -1), (1, 1)):
                p = 1 / 256
                for k in range(1, 6):
                    p = (follow[side].get(g[-k:], 0) + 4 * p) / (context[side].get((k, g[-k:-1]), 0) + 4)
                total += sign * np.log(p)
        out[text] = total / len(places(text))
    return out


def test_url_scores_count_every_gram_exactly(spark):
    """More distinct grams than 65,536, the held-out fifth among them, repeated URLs counted each."""
    rng = random.Random(8)

    def some(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789-é") for _ in range(n))

    found = [f"h://{some(9)}.com/{kind}/{some(14)}" for kind in ("fr", "de", "de") for _ in range(1500)]
    found += [f"h://{some(5)}.net/{kind}/{some(4)}" for kind in ("fr", "de", "xx") for _ in range(20)] + found[:3] * 40
    rows = urls.judge(pages(spark, found)).collect()
    assert len(rows) == len(found)
    body = dict(enumerate(found))
    known = [(body[r["page_id"]], int(r["verdict"] == "allow")) for r in rows if r["rule"]]
    assert len({b[i : i + 5] for b, _ in known for i in range(len(b) - 4)}) > 65536
    want = plain_url_scores(known, {body[r["page_id"]] for r in rows if not r["rule"]})
    assert all(abs(r["score"] - want[body[r["page_id"]]]) < 1e-8 for r in rows if not r["rule"])
    held = [(t, y) for t, y in known if not zlib.crc32(t.encode()) % 5]
    learned = plain_url_scores([(t, y) for t, y in known if zlib.crc32(t.encode()) % 5], {t for t, _ in held})
    bins = np.zeros((2, urls.BINS))
    for t, y in held:
        bins[y, int((learned[t] + urls.REACH) / (2 * urls.REACH / urls.BINS))] += 1
    threshold = urls._balance(bins)
    assert all((r["verdict"] == "allow") == (r["score"] >= threshold) for r in rows if not r["rule"])
    assert {r["verdict"] for r in rows if not r["rule"]} == {"allow", "block"}


def test_url_model_reads_the_whole_url(spark):
    """Queries, fragments, schemes and URLs without a scheme tell URLs apart."""
    ruled = [f"h://a{i}.com/{kind}/?{word}={i}" for i in range(40) for kind, word in (("fr", "welcome"), ("de", "unwanted"))]
    asked = ["h://a.net/x?welcome=1", "h://a.net/x?unwanted=1", "h://a.net/x#welcome", "h://a.net/x#unwanted", "welcome", "unwanted", "g://a.net/x", "h://a.net/x", None, ""]
    rows = {r["page_id"]: r for r in urls.judge(pages(spark, ruled + asked)).collect()}
    own = [rows[len(ruled) + i] for i in range(len(asked))]
    assert [r["verdict"] for r in own[:6]] == ["allow", "block"] * 3
    assert own[6]["score"] != own[7]["score"] and own[8]["score"] == own[9]["score"]
    assert len({r["score"] for r in own}) == len(asked) - 1


def test_url_models_take_few_tables_and_shuffles(spark, monkeypatch):
    """Each has its tasks and files, one a partition, however little it holds.  Places of grams are not broadcast."""
    plans, store = {}, urls.stored

    def planned(df):
        return df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(urls, "stored", lambda df, label: (plans.update({f"{label}-{len(plans)}": planned(df)}), store(df, label))[1])
    plans["rows"] = planned(urls.judge(pages(spark, [u[0] for u in URLS])))
    assert len(plans) <= 4
    assert sum(plan.count("Exchange hashpartitioning") for plan in plans.values()) <= 10
    valued = [line for plan in plans.values() for line in plan.splitlines() if "Join [gram" in line]
    assert len(valued) == 1 and "LeftOuter" in valued[0] and "BuildLeft" not in valued[0]


@pytest.fixture(scope="module")
def reference_encoding():
    with open(bpe.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.VOCABULARY, "rb") as file:
        return bpe.Encoder(bpe.Vocabulary(file.read()))


def test_bpe_tables(spark, reference_encoding):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd_documents(spark).select("doc_id", "text"))
    got = {(r["doc_id"], r["decoded_sha256"]): r for r in bpe.digest(bpe.decode(bpe.encode(docs))).collect()}
    for r in docs.collect():
        raw = (r["text"] or "").encode()
        ids = reference_encoding.encode_ordinary(r["text"] or "")
        own = got[r["doc_id"], hashlib.sha256(raw).hexdigest()]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    assert bpe.decode(bpe.encode(no_documents(spark))).collect() == []


def test_bpe_slices_on_random_text(reference_encoding, encoder):
    rng = random.Random(5)
    parts = ["'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "b", "é", "1", "٣", "—", "!", "S", "re", "\u3000", "\x1c", "\x85", "\0", "日", "😀", "\u200b", "²", "Ⅷ"]
    for _ in range(3000):
        x = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert bpe.encode_texts(encoder, ["q", x, "'s"])[1].tolist() == reference_encoding.encode_ordinary(x)
    for _ in range(300):
        x = "".join(chr(c) for c in (rng.randrange(0x110000) for _ in range(30)) if not 0xD800 <= c < 0xE000)
        assert bpe.encode_texts(encoder, [x])[0].tolist() == reference_encoding.encode_ordinary(x)


def test_batches_for_python_workers_are_bounded_by_bytes(spark):
    """A batch of rows with long texts stays small, whatever the limit on its rows."""
    import pyarrow as pa

    from tierwell.tuning import tune

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "rows"])

    texts = tune(spark).range(0, 4000, 1, 1).selectExpr("id", "repeat('word ', 1000) AS text")
    found = texts.mapInArrow(sizes, "size long, rows long").collect()
    assert sum(r["rows"] for r in found) == 4000
    assert max(r["size"] for r in found) < 6 << 20


def test_bpe_long_texts_and_a_small_cache(reference_encoding, encoder):
    text = "ab'sé 12 " * 3000 + "x" * 3000 + " " * 500 + "y"
    assert np.concatenate([encoder(p)[0] for p in bpe.long_slices(text, 1000)]).tolist() == reference_encoding.encode_ordinary(text)
    tiny = bpe.Encoder(encoder.vocabulary, cached=5)
    words = ["the cat sat", "on the mat", "and then some more words"]
    assert [t.tolist() for w in words for t in bpe.encode_texts(tiny, [w])] == [reference_encoding.encode_ordinary(w) for w in words]


def test_text_slices_cover_all_rows():
    import pyarrow as pa

    texts = pa.array(["a" * 10, None, "b" * 100, "", "c"])
    found = [(s, t) for s, part in text_slices(texts, 20) for s, t in zip(range(s, s + len(part)), part, strict=True)]
    assert [t for _, t in found] == [t or "" for t in texts.to_pylist()] and [s for s, _ in found] == list(range(5))
    assert ODD_IDS[4] == ODD_IDS[3]


# -- licenses: priority, containment, versions, long texts ----------------------------------------


def plain_uncontained(found):
    """By comparing all pairs."""
    kept = []
    for one in sorted(found, key=lambda x: (-x[3], x[0] - x[1], x)):
        if not any(k[0] <= one[0] and one[1] <= k[1] for k in kept):
            kept.append(one)
    return sorted(kept)


def test_priority_and_containment_by_brute_force():
    rng = random.Random(11)
    for _ in range(400):
        spans = set()
        for _ in range(rng.randint(0, 14)):
            a = rng.randint(0, 12)
            spans.add((a, a + rng.randint(1, 6), rng.choice("xyz")))
        found = [(*s, rng.choice((10, 50, 90)), 0.5) for s in spans]
        assert sorted(licenses.uncontained(found)) == plain_uncontained(found)


def test_license_versions():
    def labels(text):
        return sorted({k[2] for k in licenses.Scanner().scan(text).kept})

    assert labels("Licensed under the GNU Free Documentation License, Version 1.1.") == ["gfdl-1.1"]
    assert labels("Licensed under the EUPL version 1.1") == ["eupl-1.1"] and labels("Licensed under the EUPL v1.2") == ["eupl-1.2"]
    assert labels("Licensed under CDDL 1.1 only") == ["cddl-1.1"] and labels("Licensed under CDDL") == ["cddl"]
    assert labels("Licensed under the MIT and Apache 2.0 licenses.") == ["apache-2.0", "mit"]


def test_license_scan_is_linear_in_the_text():
    scanner = licenses.Scanner()
    start = time.process_time()
    found = scanner.scan("mit license " * 90_000)  # 1.08 MB
    assert len(found.base) == 90_000 and found.base[-1] == (2 * 90_000 - 2, "mit") and found.n_words == 180_000
    # "mit license" and, between two of them, "license mit".
    assert len(found.kept) == 179_999 and found.kept[-1][:3] == (2 * 90_000 - 2, 2 * 90_000, "mit")
    # Far below the minutes that comparing all pairs would take, on a slow machine too.
    assert time.process_time() - start < 8
    assert len({(r.label, r.pattern, r.priority) for r, _ in scanner.rules}) == len(scanner.rules)


# -- more languages than are scored at once -------------------------------------------------------


def test_any_number_of_languages(spark):
    rng = random.Random(12)
    names = [f"l{i:03d}" for i in range(150)]
    words = {n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3)] for n in names}
    texts = [" ".join(rng.choices(words[n], k=12)) for n in names for _ in range(4)]
    langs = [n for n in names for _ in range(4)]
    docs = documents(spark, texts, list(range(len(texts))), langs)
    rows = language.identify(docs).collect()
    assert len(rows) == 600
    right = sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows)
    assert right > 560 and all(0 < r["score"] <= 1 for r in rows)
    # Scores in groups are those of all languages at once.
    model = language.train(language.training_rows(docs))
    assert len(model.languages) > 140
    got = language.score_texts(model, texts[:40])
    for text, name, score in zip(texts, *got, strict=False):
        total = model.log_prior.astype(float).copy()
        grams = language.Grams(language.ORDERS, language.BITS)
        for codes, owner in grams.blocks([text]):
            for _, slot in grams.hashed(codes, owner):
                total += model.log_prob[slot].sum(axis=0, dtype=float)
        share = np.exp(total - total.max())
        assert model.languages[int(total.argmax())] == name and score == pytest.approx(1 / share.sum(), rel=1e-6)


def test_language_counts_of_many_groups(spark):
    """Counts handed on in the middle add up to the same."""
    names = [f"l{i:03d}" for i in range(64 * 6)]
    docs = documents(spark, ["ab " + n for n in names] * 2, list(range(2 * len(names))), names * 2).coalesce(1)
    model = language.train(docs)
    slots = {s for codes, owner in language.Grams(language.ORDERS, language.BITS).blocks(["ab l"]) for _, s in language.Grams(language.ORDERS, language.BITS).hashed(codes, owner) for s in s.tolist()}
    assert len(model.languages) == len(names) and model.log_prob.shape == (1 << language.BITS, len(names))
    assert np.allclose(model.log_prob[sorted(slots)], model.log_prob[sorted(slots)][:, :1])


# -- toxicity: what counts towards the bound, repeats, and the fit ---------------------------------


def test_labels_without_a_text_take_no_place(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_CLASS", 10)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    some = ids[-40:]
    docs = documents(spark, [None if i == some[0] else f"text {i}" for i in some], some)
    sample, share = toxicity.training_sample(docs, labels)
    assert {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()} == {0: 10, 1: 10}
    rated = [k % 2 for k, i in enumerate(ids) if i in some[1:]]
    assert share == pytest.approx(sum(rated) / len(rated))


def test_repeated_documents_teach_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_CLASS", 5)
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1][:8]
    docs = documents(spark, ["b", "a", *["c"] * 500, *"defghi"], [ids[0], ids[0], *[ids[1]] * 500, *ids[2:]])
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)] * 3, "doc_id long, toxic int")
    sample, share = toxicity.training_sample(docs, labels)
    assert sorted(r["text"] for r in sample.collect()) == ["a", "c", *"defghi"] and share == 0.5


def test_fit_by_plain_loops():
    """The accelerated fit against many plain gradient steps on dense rows, both to where the gradient is nothing."""
    rng = np.random.default_rng(13)
    x = rng.random((80, 12)) < 0.4
    ratio = rng.normal(size=12)
    labels = (x[:, 0] | (rng.random(80) < 0.3)).astype(float)
    weight, bias = toxicity._fit([np.flatnonzero(r) for r in x], labels, ratio, 0.2)
    dense, each = x * ratio, np.where(labels == 1, 0.2 / labels.sum(), 0.8 / (1 - labels).sum())

    def loss(w, b):
        margin = dense @ w + b
        return (each * (np.logaddexp(0, margin) - labels * margin)).sum() + toxicity.PENALTY / 2 * (w**2).sum()

    w, b = np.zeros(12), 0.0
    for _ in range(60_000):
        miss = each * (1 / (1 + np.exp(-(dense @ w + b))) - labels)
        w, b = w - 0.5 * (dense.T @ miss + toxicity.PENALTY * w), b - 0.5 * miss.sum()
    assert loss(weight, bias) - loss(w, b) < 1e-4
    assert np.abs(1 / (1 + np.exp(-(dense @ weight + bias))) - 1 / (1 + np.exp(-(dense @ w + b)))).max() < 0.02
