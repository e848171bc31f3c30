import random
import re

from pacekit.llm import licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "cc by cc by cc-BY", "apache apache license license", "gnu gnu general public license public license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including", "permission is hereby granted free of charge but nothing else",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "word " * 5000 + "mit license", "MITİ license mit\x00license café cc by", "apache  \n license", "gnu lesser general public license", "",
    "licensed to you under the apache license version 2 0", None]


def test_base_phrases_and_labels(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(None, "mit license"), (5, "mit license")], "doc_id long, text string")
    got = licenses.scan_licenses(df).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "mit license" if r["doc_id"] is None or (r["doc_id"] == 5 and r["n_words"] == 2) else TEXTS[r["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(r["labels"])
    labels = {r["doc_id"]: r["labels"] for r in got if r["doc_id"] not in (None, 5)}
    assert labels[0] == "apache,apache-2.0" and labels[1] == "gpl,gpl-3.0" and labels[3] == "cc-by,cc-by-nc-4.0"
    assert labels[7] == "mit" and labels[8] == "" and labels[9] == "bsd" and labels[13] == "lgpl" and labels[14] == ""
    score = {r["doc_id"]: r["score"] for r in got if r["doc_id"] not in (None, 5)}
    assert score[7] == 1.0 and score[15] == 1.0 and score[8] == 0.0


def test_odd_rows(odd_docs, odd_rows, clashing, no_docs):
    for docs in (odd_docs, clashing):
        got = licenses.scan_licenses(docs).collect()
        assert sorted(map(str, [(r["doc_id"], r["n_words"]) for r in got])) == sorted(map(str, [(r[0], brute(r[1])[0]) for r in odd_rows]))
    assert licenses.scan_licenses(no_docs).count() == 0


def test_document_frequency(odd_docs, odd_rows):
    df, n = licenses.document_frequency(odd_docs, {b"again", b"and", b"kan"})
    tokens = [set(re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or ""))) for r in odd_rows]
    assert n == len(odd_rows) and all(df.get(w.encode(), 0) == sum(w in t for t in tokens) for w in ("again", "and", "kan"))


def brute_labels(ws):
    """Every template at every place: its key phrases must stand where the template has them."""
    found = set()
    for t in licenses.BASE + licenses.TEXTS:
        template = t.text.split()
        keys = []
        for k in t.keys or (t.text,):
            k = k.split()
            keys.append((next(i for i in range(len(template)) if template[i:i + len(k)] == k), k))
        for start in range(-len(template), len(ws)):
            if all(start + at >= 0 and ws[start + at:start + at + len(k)] == k for at, k in keys):
                found.add(t.label)
    return found


def test_labels_against_brute_force_for_any_idf():
    """Mutated templates, whichever of their words the corpus makes rare."""
    rng = random.Random(4)
    entries = licenses._compile(licenses.BASE + licenses.TEXTS)
    vocabulary = sorted({w for e in entries for w in e.words})
    texts = []
    for t in licenses.TEXTS:
        ws = t.text.split()
        for _ in range(12):
            copy = list(ws)
            for _ in range(rng.choice((0, 1, 1, 2, 4))):
                copy[rng.randrange(len(copy))] = rng.choice(["program", "the", rng.choice(ws)])
            if rng.random() < 0.3:
                del copy[rng.randrange(len(copy))]
            texts.append(["word"] * rng.randint(0, 3) + copy + ["license"] + rng.choice([[], list(ws)]))
    want = [brute_labels(ws) for ws in texts]
    assert sum(map(bool, want)) > 100 and not all(want)
    for _ in range(6):
        index = licenses.Index(entries, {w: rng.choice((1, 5, 1000)) for w in vocabulary}, 1000)
        for ws, labels in zip(texts, want):
            assert {entries[t].label for t, _, _ in index.scan(" ".join(ws).encode())[1]} == labels


def test_a_rare_word_outside_the_key_phrases():
    text = ("permission is hereby granted free of charge to any person obtaining a copy of this program and associated documentation files "
            "the program to deal in the software without restriction")
    entries = licenses._compile(licenses.BASE + licenses.TEXTS)
    df = {w: 900 for e in entries for w in e.words} | {b"software": 1}
    assert {entries[t].label for t, _, _ in licenses.Index(entries, df, 1000).scan(text.encode())[1]} == {"mit"}
