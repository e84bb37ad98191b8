"""Each operator against brute force on a small table of hard cases."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tessera.llm import bpe, jaccard, language, licences, packing, quality, repeats, rindex, toxicity
from tessera.llm.samples import remainder


def texts(docs):
    return sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)


def test_bpe_equals_the_library(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    got = bpe.encode(docs, tokens, public_tokenizers.PATTERN, ["doc_id", "text"]).select("doc_id", "text", "bpe.ids")
    for r in got.collect():
        assert r.ids == library.encode_ordinary(r.text or "")
    back = bpe.decode(got, tokens, ["text"]).select("text", "bytes.decoded")
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert bpe.encode(empty, tokens, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


def test_near_copies_equal_brute_force(docs, empty):
    sets = {}
    for i, t in texts(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")  # the fixture is lower-case
        s = set(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else ({tuple(w)} if w else set())
        if i is not None:
            sets.setdefault(i, []).append(s)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and any(s and 100 * len(s & t) >= 80 * len(s | t) for s in sets[i] for t in sets[j] if t):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = jaccard.near_copies(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.component_id == find(r.doc_id)
            assert r.n_shingles in [len(s) for s in sets[r.doc_id]]
    assert len({find(20 + k) for k in range(4)}) < 4  # the chain links
    assert jaccard.near_copies(empty).count() == 0


def test_cells_of_split_blocks_find_the_same_groups(docs, monkeypatch):
    whole = sorted(jaccard.near_copies(docs).collect(), key=str)
    monkeypatch.setattr(jaccard, "CELL", 300)
    assert sorted(jaccard.near_copies(docs).collect(), key=str) == whole


def test_trie_links_connect_what_brute_force_connects():
    rng = np.random.default_rng(1)
    for _ in range(30):
        base = rng.integers(0, 1 << 60, 30).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.permutation(base)[:rng.integers(20, 31)],
                                          rng.integers(0, 1 << 60, rng.integers(0, 4)).astype(np.uint64)]))
                for _ in range(12)]

        def groups(pairs):
            label = list(range(len(sets)))
            for a, b in pairs:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
            return label

        want = [(i, j) for i in range(12) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j]))
                >= 80 * len(np.union1d(sets[i], sets[j]))]
        assert groups(jaccard.trie_links(sets, 80, 100)) == groups(want)


def test_repeats_equal_brute_force(docs, empty):
    raws = [(t or "").encode() for _, t in texts(docs)]
    count = collections.Counter(b[i:i + 200] for b in raws for i in range(len(b) - 199))
    want = collections.Counter()
    for (i, _), b in zip(texts(docs), raws, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k:k + 200]] > 1:
                gone[k:k + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        want[(i, len(b), int(gone.sum()), spans, kept)] += 1
    got = repeats.remove_repeats(docs, ["doc_id"]).select("doc_id", "repeats.*").collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == want
    assert repeats.remove_repeats(empty, ["doc_id"]).count() == 0


def test_run_length_index_marks_repeats():
    strings = [b"abcabcabc" * 5, b"xyz" + b"abcabc" * 4, b"q" * 40, b"unique text of no repeat at all"]
    count = collections.Counter(s[i:i + 12] for s in strings for i in range(len(s) - 11))
    for s, got in zip(strings, rindex.repeated_starts(strings, 12), strict=True):
        assert got.tolist() == [i for i in range(len(s) - 11) if count[s[i:i + 12]] > 1]


def test_packing_is_an_exact_cover(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    want = collections.Counter(
        hashlib.sha256(np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()).hexdigest()
        for _, t in texts(docs))
    rows = packing.pack(docs, definition, end_id=1).collect()
    sequences = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and (at & (at - 1)) == 0  # full, or a power of two: no padding
    single = [r for r in rows if r.start == 0 and r.length == r.doc_tokens]
    whole = collections.Counter(hashlib.sha256(bytes(r.ids)).hexdigest() for r in single)
    assert not whole - want
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert packing.pack(empty, definition, end_id=1).count() == 0


def test_plan_places_every_remainder_once():
    rng = np.random.default_rng(3)
    hist = np.bincount(rng.integers(1, 64, 500), minlength=64)
    plan = packing.make_plan(hist, 64)
    used = collections.Counter()
    for length in range(1, 64):
        for rank in range(hist[length]):
            parts = plan.place(length, rank)
            assert sum(p[1] for p in parts) == length
            for _, size, sequence, offset in parts:
                for k in range(size):
                    used[(sequence, offset + k)] += 1
    assert max(used.values()) == 1 and len(used) == int((hist * np.arange(64)).sum())
    assert max(s for s, _ in used) < plan.sequences


def test_language_profiles(docs, empty, spark):
    rows = [(i, t, n) for i in range(40) for t, n in ((f"the cat and the dog number {'x' * (i % 3)} sat", "en"),
                                                      (f"der hund und die katze {'y' * (i % 3)} schlafen", "de"))]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(train, remainder("doc_id", 4) != 2)
    assert model.predict(["the dog", "die katze und der hund", None, "12 !"])[0] == ["en", "de", "und", "und"]
    got = language.predict(docs, model, ["doc_id", "text"]).select("text", "language.*").collect()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)
    assert language.predict(empty, language.fit(empty, remainder("doc_id", 4) != 2), ["doc_id"]).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_held_out_accuracy(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    truth = {r.doc_id: r for r in labels.collect()}

    def accuracy(scored, label):
        rows = [r for r in scored.collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
        return np.mean([r.predicted == truth[r.doc_id][label] for r in rows])

    forest = quality.fit(docs, labels)
    assert accuracy(quality.score(docs, forest, ["doc_id"]).select("doc_id", "quality.predicted"), "quality") > 0.95
    lexicon = toxicity.fit(docs, labels)
    assert accuracy(toxicity.score(docs, lexicon, ["doc_id"]).select("doc_id", "toxicity.predicted"), "toxic") > 0.9


def test_classifiers_take_hard_rows(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (7, 0, None), (9, None, 1), (11, 0, 1), (3, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        for rows, marks in ((docs, labels), (docs, labels.limit(0)), (empty, labels)):
            model = module.fit(rows, marks, label)
            got = module.score(rows, model, ["doc_id", "score"], out="result").select("result.score").collect()
            assert len(got) == rows.count() and all(0 <= r.score <= 1 for r in got)



def test_licences(docs, empty):
    model = licences.fit(docs)
    got = licences.scan(docs, model, ["doc_id"]).select("doc_id", "licence.*").collect()
    assert {r.doc_id: [f.family for f in r.findings] for r in got if r.findings} == {16: ["apache-2.0"]}
    assert licences.scan(empty, licences.fit(empty), ["doc_id"]).count() == 0


def test_every_notice_line_of_the_table_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = {"all rights reserved": "all-rights-reserved", "mit license": "mit", "apache license": "apache-2.0",
             "gnu general public": "gpl", "cc by-nc": "cc-by-nc"}
    want = collections.Counter((r.doc_id, family) for r in docs.collect() for line in re.split("[\r\n]", r.text or "")
                               for mark, family in marks.items() if mark in line.lower())
    got = licences.scan(docs, licences.fit(docs), ["doc_id"]).select("doc_id", "licence.findings").collect()
    assert collections.Counter((r.doc_id, f.family) for r in got for f in r.findings) == want
    assert len({family for _, family in want}) == 5


def test_reserved_rights(spark, docs):
    rows = ["All rights reserved.", "# Copyright (c) 2019 Some Owner", "Copyright 1998 Quite Another Firm Ltd.",
            "Copyright \u00a9 2024 Somebody. All rights reserved.", "The right to copy was theirs in 2019."]
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = licences.scan(table, licences.fit(docs), ["doc_id"]).select("doc_id", "licence.findings").collect()
    assert {r.doc_id: [f.family for f in r.findings] for r in got} == {i: ["all-rights-reserved"] * (i < 4) for i in range(5)}


WRAPPED = {
    "mit": """// Permission is hereby granted, free of charge, to any person obtaining a copy
// of this software and associated documentation files (the "Software"), to deal
// in the Software without restriction, including without limitation the rights
// to use, copy, modify, merge, publish, distribute copies of the Software.""",
    "gpl": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.""",
    "lgpl": """    This library is free software; you can redistribute it and/or\r
    modify it under the terms of the GNU Lesser General Public\r
    License as published by the Free Software Foundation""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:""",
    "all-rights-reserved": "The owner has all of it.  All rights\nreserved.",
}


def test_wrapped_notices(spark, docs):
    rows = [(f"a {mark}\nfirst line\n" + text + "\n\nlast line", family)
            for family, text in WRAPPED.items() for mark in ("b", "\u00e9")]
    rows += [(text + "\n" + text, [family] * 2) for family, text in WRAPPED.items() if family != "all-rights-reserved"]
    rows.append(("Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", ["cc-by-nc"] * 2))
    rows.append(("\n".join("Permission is hereby granted, free of charge, to any person".split()), []))
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = licences.scan(table, licences.fit(docs), ["doc_id"]).select("doc_id", "licence.findings").collect()
    for r in got:
        text, want = rows[r.doc_id]
        assert [f.family for f in r.findings] == ([want] if isinstance(want, str) else want), text
        if isinstance(want, str):
            f = r.findings[0]
            span = text.encode()[f.begin:f.end].decode()
            assert "\n" in span and span in WRAPPED[want]


def test_notices_of_a_hot_source_are_no_negatives(spark, docs):
    import random

    rng = random.Random(2)
    plain = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(12)) for _ in range(900)]
    header = WRAPPED["mit"].split("\n")[0]
    rows = [(i, "\n".join([["Released under the MIT License.", header][i % 2]] * (i % 3 == 0) + plain[3 * i:3 * i + 3]))
            for i in range(300)] + [(0, "Released under the MIT License.")] * 300
    table = spark.createDataFrame(rows, "doc_id long, text string")
    lines = licences.ordinary_lines(table)
    assert len(set(lines)) == len(lines) > 250 and set(lines) <= set(plain)
    assert set(lines) - {t.split("\n")[0] for _, t in rows}
    got = licences.scan(table, licences.fit(table), ["doc_id", "text"]).select("text", "licence.findings").collect()
    assert all([f.family for f in r.findings] == ["mit"] * r.text.count("MIT License") for r in got)
    assert licences.ordinary_lines(docs.where("text is null or trim(text) = ''")) == []
