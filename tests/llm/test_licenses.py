import random
import re

import pytest

from stratagrid.llm import licenses


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def by_hand(text, templates, threshold):
    w = words(text or "")
    places, base, best, found = [], set(), 0.0, set()
    for p, label in licenses.PHRASES.items():
        for i in range(len(w)):
            if w[i : i + len(p.split())] == p.split():
                places.append(i)
                base.add(label)
    for line in (text or "").split("\n"):
        own = set(words(line))
        for name, t in templates.items():
            want = set(words(t))
            share = len(want & own) / len(want) if want else 0.0
            if want and share >= threshold - 1e-9:
                found.add(name)
                best = max(best, share)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if places else best


FIELDS = [n for n, _ in licenses.FIELDS]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_join_is_exact(spark, threshold):
    rng = random.Random(3)
    some = sorted({w for t in licenses.TEMPLATES.values() for w in t.split()})
    rows = [(i, "\n".join(" ".join(rng.choice(some) for _ in range(rng.choice([0, 3, 8, 40, 90]))) for _ in range(3))) for i in range(150)]
    rows += [(1000 + i, f"intro É\nX {t.upper()}. y") for i, t in enumerate(licenses.TEMPLATES.values())]
    rows += [(2000, "CC-BY cc\nby All  rights\treserved, general public license"), (2001, None), (2002, "")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold).collect()}
    for i, text in rows:
        assert tuple(got[i][f] for f in FIELDS) == pytest.approx(by_hand(text, licenses.TEMPLATES, threshold)), text


def test_odd_rows(odd_docs):
    got = licenses.scan_licenses(odd_docs)
    assert got.columns == ["doc_id", "text", "n_lines", *FIELDS, "spans"]  # score is replaced
    assert sorted(str(tuple(r[f] for f in FIELDS)) for r in got.collect()) == sorted(str(by_hand(r["text"], licenses.TEMPLATES, licenses.THRESHOLD)) for r in odd_docs.collect())


def test_spans_and_empty(spark, no_docs):
    assert licenses.scan_licenses(no_docs).count() == 0
    row = licenses.scan_licenses(spark.createDataFrame([(1, "two words\nReleased under the MIT License.")], "doc_id long, text string")).first()
    assert [tuple(s) for s in row["spans"]] == [("mit", 2, 5, 1.0)] and row["labels"] == "mit" and row["n_base"] == 0


WRAPPED = {
    "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that",
    "mpl": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy",
    "mit": "It is released under\ndnl the MIT\ndnl License",
    "apache": "Licensed under the\n\nApache License, Version\n2.0",
}


def test_wrapped_notices(spark, tmp_path):
    rows = [(i, f"some text before\n{t}\nand after") for i, t in enumerate(WRAPPED.values())]
    rows += [(10, "released\n" + "w " * 20 + "\nunder the mit license"), (11, "the\nReleased under the MIT License.\nreleased"), (12, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.op9_license_scan(spark, str(tmp_path)).collect()}
    want = dict(enumerate((name, 1.0) for name in WRAPPED)) | {10: ("", 0.0), 11: ("mit", 1.0), 12: ("", 0.0)}
    assert got == want
    spans = licenses.scan_licenses(spark.createDataFrame(rows[2:3] + rows[5:6], "doc_id long, text string"), across_lines=True).collect()
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in spans} == {2: [("mit", 5, 7, 1.0)], 11: [("mit", 1, 5, 1.0)]}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9])
def test_windows_are_exact(spark, threshold):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        some = rng.choice(list(licenses.TEMPLATES.values())).split() + ["x", "y", "the"]
        rows.append((i, "\n".join(" ".join(rng.choice(some) for _ in range(rng.choice([0, 1, 3, 6]))) for _ in range(8))))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold, phrases={}, across_lines=True).collect()}
    more = 0
    for i, text in rows:
        w, best, found = words(text), 0.0, set()
        for name, t in licenses.TEMPLATES.items():
            want, n = set(words(t)), 2 * len(words(t))
            blocks = [words(x) for x in text.split("\n")] + [w[k : k + n] for k in range(len(w))]
            share = max(len(want & set(b)) / len(want) for b in blocks)
            if share >= threshold - 1e-9:
                found.add(name)
                best = max(best, share)
        assert (got[i]["labels"], got[i]["score"]) == (",".join(sorted(found)), pytest.approx(best)), text
        for s in got[i]["spans"]:
            want = set(words(licenses.TEMPLATES[s["label"]]))
            assert len(want & set(w[s["first"] : s["first"] + s["words"]])) / len(want) == pytest.approx(s["containment"])
        more += len(found) > 0
    assert more > 10


def test_whole_texts(spark, tmp_path):
    """Whole license texts, wrapped as files and comments wrap them, with some words of their own, and halves of them."""
    rows, want = [], {}
    for i, (name, text) in enumerate(licenses.TEXTS.items()):
        w = text.split()
        for j, (width, lead) in enumerate(((60, "# "), (100, " * "), (40, "// "))):
            lines, line = [], lead
            for x in w:
                if len(line) + len(x) > width:
                    lines.append(line)
                    line = lead
                line += x + " "
            rows.append((10 * i + j, "code before\n\n" + "\n".join([lead + "Copyright (c) 2001 Some One", *lines, line]) + "\n\ncode after\n" * 5))
            want[10 * i + j] = name
        rows.append((10 * i + 9, "code\n" + "\n".join(w[: len(w) // 2])))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in licenses.op9_license_scan(spark, str(tmp_path)).collect():
        own = set(r["labels"].split(",")) & set(licenses.TEXTS)
        assert own == ({want[r["doc_id"]]} if r["doc_id"] in want else set()), r
        assert r["doc_id"] not in want or r["score"] >= licenses.THRESHOLD


def test_templates_from_files(spark, tmp_path):
    (tmp_path / "own-1.0.txt").write_text("Only with our\nwritten leave")
    (tmp_path / "other").write_text("Do as you please with this")
    found = licenses.read_templates(spark, str(tmp_path))
    assert found == {"own-1.0": "Only with our\nwritten leave", "other": "Do as you please with this"}
    got = licenses.scan_licenses(spark.createDataFrame([(1, "x only with\nour written\nleave y")], "doc_id long, text string"), found, across_lines=True).first()
    assert got["labels"] == "own-1.0"
    with pytest.raises(ValueError, match="more than 1"):
        licenses.read_templates(spark, str(tmp_path), at_most=1)


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "released under the MIT license")], "doc_id long, text string").selectExpr("*", "1 AS n_words", "'x' AS labels", "2 AS word", "3 AS n", "4 AS spans")
    got = licenses.scan_licenses(df)
    assert got.columns == ["doc_id", "text", "word", "n", *FIELDS, "spans"] and got.first()["labels"] == "mit"
