"""SimHash, embeddings, top-k, repeated passages, packing, components and the pipeline, by brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.cases import CLASHING, N_CLASHING, ODD_IDS, ODD_TEXTS, documents, no_documents, odd_documents
from tests.oracle import compare, connect
from tierwell.llm import embeddings, packing, simhash, substrings, topk, words
from tierwell.llm.components import components, local_roots

SMALL = "/root/testdata/sf0.001"


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    n, rng = 60, random.Random(3)
    links = {"path": [(i, i + 1) for i in range(n - 1)], "star": [(7, i) for i in range(n)], "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(35)], "none": [(1, 1)]}[shape]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links + [(None, 3)], "a long, b long")).collect()}
    want = roots(n, links)
    assert found == {i: want[i] for i in {x for a, b in links if a != b for x in (a, b)}}
    left, right = (np.array(x) for x in zip(*links, strict=True))
    assert local_roots(n, left, right).tolist() == want


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def check_simhash(rows, docs):
    prints = [plain_fingerprint(d["text"]) for d in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    group = roots(len(docs), links)
    least = {}
    for d, g in zip(docs, group, strict=True):
        if d["doc_id"] is not None:
            least[g] = min(least.get(g, d["doc_id"]), d["doc_id"])
    want = collections.Counter((d["doc_id"], f"{p:016x}", least.get(g)) for d, p, g in zip(docs, prints, group, strict=True))
    assert collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == want


def test_simhash_tables_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd_documents(spark).select("doc_id", "text"))
    check_simhash(simhash.near_duplicates(docs).collect(), docs.collect())
    assert simhash.near_duplicates(no_documents(spark)).collect() == []
    kept = simhash.keep_one_each(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert collections.Counter(r["doc_id"] for r in kept.collect())[4] == 1


def test_bit_sliced_comparison_and_split_cells(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base[:60] ^ np.uint64(0b1111), base[:40] ^ np.uint64(0b11111 << 40), base[:70] ^ np.uint64(1 << 63 | 1 << 20)]))
    pairs = {(i, j) for i in range(len(values)) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 4}
    assert set(zip(*(x.tolist() for x in simhash.within(values, values)), strict=True)) == pairs
    want = roots(len(values), pairs)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    number = {int(v): i for i, v in enumerate(values.view(np.int64))}
    for n, cell in ((len(values), 2048), (len(values), 5), (1 << 40, 2048)):
        links = [(number[r["a"]], number[r["b"]]) for r in simhash.near_links(frame, n, cell=cell).collect()]
        assert roots(len(values), links) == want


def test_block_layout_covers_every_pair():
    for n in (0, 1, 5000, 10**6, 10**9, 10**12):
        blocks, agree, bits = simhash.block_layout(n)
        assert blocks - agree >= simhash.RADIUS and 64 // blocks >= bits


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_of_the_pipeline_by_brute_force(spark):
    """One row of each group of fingerprints linked at the radius, the smallest doc_id."""
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.randint(60, 300))]
        texts += [" ".join(base)] + [edited(rng, base, rng.randint(0, 2)) for _ in range(4)]
    common = [f"c{i}" for i in range(200)]
    texts += [edited(rng, common, 1) for _ in range(40)] + [texts[0]] * 60
    texts += [None, "", " ", "a b", "A  b", "a b c"]
    prints = [plain_fingerprint(t) for t in texts]
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    group = roots(len(texts), near)
    rows = simhash.keep_one_each(documents(spark, texts)).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted({g: i for i, g in reversed(list(enumerate(group)))}.values())
    assert len(rows) < len(texts) - 100 and all(r["text"] == texts[r["doc_id"]] for r in rows)


def test_rows_without_an_id_go_last_in_the_pipeline(spark):
    docs = documents(spark, ["same text here", "same text here", "same text here", "other words entirely now", "other words entirely now"], [None, 5, 3, None, None])
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in simhash.keep_one_each(docs).collect()) == [(False, 3), (True, None)]
    assert simhash.keep_one_each(no_documents(spark)).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, *["x"] * N_CLASHING) for i, v in rows], f"vec_id long, embedding array<float>, label_no int, {CLASHING}")


def some_vectors(n=160, dim=6):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, dim))
    rows = [(i, (centres[rng.integers(8)] + rng.normal(size=dim) * rng.choice([0.05, 0.6])).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(5)] + [(2000, [0.0] * dim), (2001, None), (2002, [1.0, None, 2.0]), (2003, [float("nan")] * dim), (2004, [float("inf")] * dim), (2005, []), (None, rows[3][1]), (2006, [1.0, 2.0]), (2007, [1.0, 2.0]), (7, rows[7][1])]
    return rows


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("cell", [4096, 20, 7])
def test_near_vectors(spark, cell):
    rows = some_vectors()
    ok = [r[0] is not None and usable(r[1]) and any(r[1]) for r in rows]
    unit = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if k else None for (_, v), k in zip(rows, ok, strict=True)]
    linked = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    group = roots(len(rows), linked)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = i if g not in least or least[g] is None else min(least[g], i if i is not None else least[g])
    n = collections.Counter(i for i, _ in linked)
    want = collections.Counter((i, n[k], least[group[k]], i is not None and i == least[group[k]]) for k, (i, _) in enumerate(rows))
    got = embeddings.near_vectors(vectors(spark, rows), cell=cell).collect()
    assert collections.Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == want


def test_no_vectors(spark):
    none = vectors(spark, some_vectors()).limit(0)
    assert embeddings.near_vectors(none).collect() == []
    assert topk.top_products(none).collect() == []


@pytest.mark.parametrize("bucket", [4096, 16])
def test_top_products(spark, bucket):
    rows = some_vectors()
    good = [(i, np.floor(64 * np.array(v, dtype=float)).astype(int)) for i, v in rows if i is not None and usable(v)]
    want = collections.Counter()
    for a, (q, x) in enumerate(good):
        if q % 20 == 0:
            scored = sorted((-int(x @ y), c) for b, (c, y) in enumerate(good) if b != a and len(y) == len(x))[:20]
            want.update((q, k + 1, c, -s) for k, (s, c) in enumerate(scored))
    got = topk.top_products(vectors(spark, rows), bucket=bucket).collect()
    assert collections.Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == want


def test_top_products_prunes_by_length_and_coordinates():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(size=(400, 8)) * rng.choice([3, 60], size=(400, 1))).astype(np.int64)
    bucket = topk.Bucket(rows, np.arange(400), np.arange(400))
    queries = rows[:50]
    scores = queries @ rows.T
    for floor in (np.partition(scores, -5, axis=1)[:, -5], scores.max(axis=1), np.full(50, -(1 << 62))):
        for q, places, found in bucket.search(queries, np.full(50, -1), floor, 400):
            assert sorted(bucket.ids[places].tolist()) == np.flatnonzero(scores[q] >= floor[q]).tolist() and (found >= floor[q]).all()


def repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()).hexdigest()))
    return collections.Counter(out)


def passages(seed):
    rng = random.Random(seed)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(n))

    shared = [prose(40) for _ in range(4)]
    texts = []
    for _ in range(80):
        parts = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p, a = rng.choice(shared), rng.randint(0, 40)
            parts += [p[a : a + rng.randint(20, 160)], prose(rng.randint(0, 10))]
        texts.append(" ".join(parts))
    return texts + [None, "", "a" * 300, "ab" * 200, texts[3], texts[3], texts[4] + "x", "x" + texts[5]]


@pytest.mark.parametrize(("chunk", "group"), [(1 << 19, 40_000), (700, 40_000), (1 << 19, 2)])
def test_repeated_passages(spark, monkeypatch, chunk, group):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    texts = passages(chunk)
    docs = documents(spark, texts, [i % 70 if i % 50 else None for i in range(len(texts))])
    found = substrings.digest(substrings.remove_repeats(docs, 40, 8, group)).collect()
    assert collections.Counter((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) == repeats(texts, 40)


def test_repeated_passages_of_400_bytes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd_documents(spark).select("doc_id", "text"))
    found = substrings.digest(substrings.remove_repeats(docs)).collect()
    assert collections.Counter((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) == repeats([r["text"] for r in docs.collect()], 400)
    assert substrings.remove_repeats(no_documents(spark)).collect() == []
    left = substrings.drop_repeats(odd_documents(spark))
    assert left.columns == odd_documents(spark).columns and left.count() == len(ODD_TEXTS)
    assert all((r["text"] is None) == (r["doc_id"] == 1) and r["n_chars"] == len(r["text"] or "") for r in left.collect())


def test_repeats_of_over_50_words_are_dropped(spark):
    """Words as units, by brute force; short words, so that 51 of them stay far below 400 bytes."""
    rng = random.Random(6)

    def prose(n):
        return [f"{rng.randrange(4000):x}" for _ in range(n)]

    caught, spared = prose(51), prose(50)
    texts = [prose(80) + caught + prose(30), prose(10) + caught + prose(90), prose(40) + spared + prose(70), prose(5) + spared, prose(20) + (again := prose(70)) + prose(9) + again, prose(300), []]
    seen = collections.Counter(tuple(t[i : i + 51]) for t in texts for i in range(len(t) - 50))
    gone = [{k for i in range(len(t) - 50) if seen[tuple(t[i : i + 51])] > 1 for k in range(i, i + 51)} for t in texts]
    assert [len(g) for g in gone] == [51, 51, 0, 0, 140, 0, 0]
    # Blanks differ between the copies.
    left = substrings.drop_repeats(documents(spark, [(" \n" if i % 2 else " ").join(t) for i, t in enumerate(texts)])).collect()
    for r in left:
        assert r["text"].split() == [w for k, w in enumerate(texts[r["doc_id"]]) if k not in gone[r["doc_id"]]]
        assert r["n_chars"] == len(r["text"])


def test_passages_of_over_50_words_are_reported(spark, tmp_path):
    """By brute force; the passages have far less than the 400 bytes that are removed, so nothing is."""
    rng = random.Random(12)

    def prose(n):
        return [f"{rng.randrange(4000):x}" if rng.randrange(9) else "é" for _ in range(n)]

    caught, spared = prose(51), prose(50)
    texts = [prose(80) + caught + prose(30), prose(10) + caught + prose(90), prose(40) + spared + prose(70), prose(5) + spared, prose(20) + (again := prose(60)) + prose(9) + again, prose(300), [], None, caught]
    # Blanks differ between the copies; ids are null or repeated.
    texts = [t if t is None else (" \n" if i % 2 else " ").join(t) for i, t in enumerate(texts)]
    docs = documents(spark, texts, [3, 3, None, 4, 5, None, 6, 7, 8])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    words = [(t or "").split() for t in texts]
    seen = collections.Counter(tuple(t[i : i + 51]) for t in words for i in range(len(t) - 50))
    expected = []
    for text, own in zip(texts, words, strict=True):
        gone = {k for i in range(len(own) - 50) if seen[tuple(own[i : i + 51])] > 1 for k in range(i, i + 51)}
        at = [m.span() for m in re.finditer(r"\S+", text or "")]
        starts, stops = sorted(k for k in gone if k - 1 not in gone), sorted(k for k in gone if k + 1 not in gone)
        expected.append((len((text or "").encode()), 0, len(starts), sum(len(text[at[a][0] : at[b][1]].encode()) for a, b in zip(starts, stops, strict=True))))
    assert [e[2] for e in expected] == [1, 1, 0, 0, 2, 0, 0, 0, 1]
    found = contract.queries()["op6_suffix_array_dedup"](spark, str(tmp_path)).collect()
    assert collections.Counter((r["n_bytes"], r["n_removed"], r["n_passages"], r["n_passage_bytes"]) for r in found) == collections.Counter(expected)


def test_both_orders_equal_pairs():
    rng = random.Random(9)
    for n in (2, 5, 40):
        core = "".join(rng.choice("ab ") for _ in range(70))
        bodies, at = [], []
        for _ in range(n):
            left = rng.choice([core[:30], "".join(rng.choice("ab") for _ in range(30))])[-rng.randint(5, 30) :]
            right = core[30 : 30 + rng.randint(10, 40)] + "".join(rng.choice("ab") for _ in range(40))
            bodies.append((left + right).encode()[: len(left) + 50])
            at.append(len(left))
        pairs, orders = substrings.repeated(bodies, at, 40, 100), substrings.repeated(bodies, at, 40, 1)
        assert all((a == b).all() for a, b in zip(pairs, orders, strict=True))
        for b, k, flags in zip(bodies, at, pairs, strict=True):
            for i, flag in enumerate(flags.tolist()):
                others = sum(o[m - (k - i) : m - (k - i) + 40] == b[i : i + 40] for o, m in zip(bodies, at, strict=True) if m - (k - i) >= 0)
                assert flag == (others > 1)


def check_packing(rows, texts, window=packing.WINDOW):
    """rows: (doc key, start, length, crc, n, sequence, offset); texts by doc key."""
    with open(packing.VOCABULARY, encoding="utf-8") as file:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(file.read())
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_sequence[r[5]].append(r)
    assert set(by_doc) == set(texts)
    for key, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[key] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for _, start, length, crc, n, _, _ in sorted(pieces, key=lambda r: r[1]):
            assert start == at and n == len(ids) and length > 0
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    odd = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r[6]):
            assert r[6] == at
            at += r[2]
        if at != window:
            odd.append(at)
    assert all(n.bit_count() == 1 and n < window for n in odd) and len(set(odd)) == len(odd)


def test_packing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = packing.digest(packing.pack(docs)).collect()
    check_packing([tuple(r) for r in found], {r["doc_id"]: r["text"] for r in docs.collect()})


def test_packing_odd_rows(spark):
    texts = [*ODD_TEXTS, "\x1c\x1d a\x85b\u2028c İΣ Å K"]
    rows = packing.digest(packing.pack(documents(spark, texts))).collect()
    check_packing([tuple(r) for r in rows], dict(enumerate(texts)))
    assert sum(r["length"] for r in packing.pack(documents(spark, texts, [*ODD_IDS, 4])).collect()) == sum(r["length"] for r in rows)
    assert packing.pack(no_documents(spark)).collect() == []


def test_chunks_equal_the_whole_text():
    with open(packing.VOCABULARY, encoding="utf-8") as file:
        encoder = packing.ChunkEncoder(file.read(), cached=40)
    rng = random.Random(8)
    parts = ["the", "The", "it's", "'s", "'", ".", '."', "»", "a\u0301", "\u0301", "É", "İ", "Σ", "ς", "ß", "12", "٣", "-", " ", "  ", "\n", "\x1c", "\x85", "\u2028", "\u3000", "\u200b", "日", "😀", "ŉ", "ǅ", "=\u0338", "K", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want = encoder.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder([text])[0], dtype=encoder.dtype).tolist() == want, repr(text)


def test_pieces_equal_the_whole_text():
    vocabulary = packing.read_vocabulary(packing.VOCABULARY)
    encoder = vocabulary.encoder()
    assert isinstance(encoder, packing.TextEncoder)
    whole = packing.WholeEncoder(vocabulary.file)

    def check(texts):
        got = [np.frombuffer(g, dtype=encoder.dtype).tolist() for g in encoder(texts)]
        want = [np.frombuffer(w, dtype=whole.dtype).tolist() for w in whole(texts)]
        for text, g, w in zip(texts, got, want, strict=True):
            assert g == w, repr(text)

    rng = random.Random(9)
    parts = ["the", "The", "it's", "'", ".", '."', "»", "é", "a\u0301", "É", "×", "÷", "ÿÞ", "İ", "ß", "12", "٣", "$$$", " ", "  ", "\n", "\x1c", "\x00", "\x7f", "\x85", "\u2028", "日", "😀", "<|endoftext|>", "antidisestablishmentarianism", "x" * 500]
    # A small table, so that pieces take each other's place and the table is given up now and then.
    encoder.pieces = words.PieceEncoder(vocabulary.ranks, encoder.dtype, encoder.pieces.others, encoder.pieces.chunks, bits=4)
    for _ in range(300):
        check(["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 8))])
    check(["", "", "a", ""])
    check([""])
    check(["word " * 4000, "9" * 1000, "é" * 20])


def test_plain_words_equal_the_library(spark):
    """Every distinct word of the given documents, and random ones of all plain letters."""
    vocabulary = packing.read_vocabulary(packing.VOCABULARY)
    library = packing.ChunkEncoder(vocabulary.file)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {w for r in docs.collect() for w in library._chunks(r["text"] or "")}
    rng = random.Random(10)
    letters = [bytes([b]).decode() for b in range(0x61, 0x7B)] + [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
    found |= {"".join(rng.choices(letters, weights=[9] * 26 + [1] * 32, k=rng.randint(1, 30))) for _ in range(20000)}
    plain = sorted(w for w in found if library._WORD.fullmatch(w))
    ids, counts = words.Words(vocabulary.ranks, library.dtype)(np.frombuffer(("\x00".join(plain) + "\x00").encode(), dtype=np.uint8))
    want = library._encoded(library.letters, plain)
    ends = np.cumsum(counts)
    assert len(plain) > 20000 and all(ids[e - n : e].tobytes() == want[w] for w, n, e in zip(plain, counts, ends, strict=True))


def test_other_vocabularies_encode_whole_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.read_vocabulary(path).pieces
    texts = ["It's  a\n test", "", None, "é ß " * 700]
    rows = packing.pack(documents(spark, texts), vocabulary=path).collect()
    tokenizer = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r["row"]["doc_id"] == i), key=lambda r: r["start"])
        got = np.frombuffer(b"".join(r["ids"] for r in own), dtype="<u4").tolist()
        assert got == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_least_squares_and_plan():
    rng = np.random.default_rng(0)
    a = rng.random((6, 9))
    x = np.where(rng.random(9) < 0.4, rng.random(9), 0)
    assert np.allclose(a @ packing.non_negative_least_squares(a, a @ x), a @ x, atol=1e-6)
    assert set(packing.combinations(8, 3)) == {(1, 7), (2, 6), (3, 5), (4, 4), (1, 1, 6), (1, 2, 5), (1, 3, 4), (2, 2, 4), (2, 3, 3)}
    found = packing.plan({3: 100, 5: 100, 4: 7}, 8)
    assert found.sequences == 103
    bins = np.repeat([3, 4, 5], [100, 7, 100])
    ranks = np.concatenate([np.arange(100), np.arange(7), np.arange(100)])
    sequence, slot, last = found.place(bins, ranks)
    placed = sequence >= 0
    assert placed.sum() == 206 and np.bincount(sequence[placed], bins[placed]).tolist() == [8.0] * 103
    assert len({*zip(sequence[placed].tolist(), slot[placed].tolist(), strict=True)}) == 206 and last[placed].sum() == 103


def test_top_k_equals_its_sql(spark):
    ok, note = compare(spark, connect(SMALL), SMALL, "op7_exact_top_k")
    assert ok, note


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == columns, name
        docs = spark.createDataFrame(after.collect(), after.schema)
        assert docs.count() > 0
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packing([tuple(r) for r in rows], left)
    assert {r["doc_id"]: r["doc_tokens"] for r in corpus_pipeline.run(spark, SMALL).collect()} == {r["doc_id"]: r["doc_tokens"] for r in rows}


def test_all_queries_are_registered():
    names = contract.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


# -- vectors of any size --------------------------------------------------------------------------


def test_top_k_of_large_components(spark):
    big = [[2.0**25, 1.0], [2.0**24, -2.0], [2.0**23, 2.0**24], [1.0, 0.0], [-(2.0**24), 3.0]]
    frame = spark.createDataFrame([(20 * i, v) for i, v in enumerate(big)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_products(frame).orderBy("query_id", "rank").collect()]
    whole = [[int(np.floor(64 * c)) for c in v] for v in big]
    want = []
    for i, q in enumerate(whole):
        scores = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), 20 * j) for j, c in enumerate(whole) if j != i)
        want += [(20 * i, k, j, -s) for k, (s, j) in enumerate(scores, start=1)]
    assert got == want


def test_top_k_beyond_longs(spark):
    frame = spark.createDataFrame([(0, [1e300, 0.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in topk.top_products(frame).orderBy("rank").collect()]
    assert got == [(1, (1 << 63) - 1), (3, 0), (2, -(1 << 63))]


def test_vectors_of_extreme_lengths_link(spark):
    vectors = [[1e200, 1e200], [2e200, 2e200], [1e-300, 1e-300], [5e-324, 5e-324], [1e308, -1e308], [1.0, -1.0], [1e-160, 0.0]]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(frame).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (3, 0), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_queries_split_hot_keys(spark):
    """Registered queries set what splits a hot key's partition, whatever ran before them."""
    from tierwell.llm import queries

    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    spark.conf.unset(name)
    queries.table(spark, SMALL, "documents")
    assert spark.conf.get(name) == "true"
