import re

from oracle import frames

from terrasift.llm import registry
from terrasift.llm.license_scan import PHRASES, scan_licenses


def test_against_sql(spark):
    got, want = frames(spark, registry.QUERIES["op8_license_scan"], registry.ORACLE["op8_license_scan"])
    norm = lambda rows: [tuple(float(x) if isinstance(x, (int, float)) else x for x in r) for r in rows]
    assert sorted(norm(got), key=repr) == sorted(norm(want), key=repr)


CASES = [
    (1, None),
    (2, ""),
    (3, "Licensed under the APACHE License -- version 2.0, and mit\nLICENSE. mit license"),
    (4, "This work is\x00licensed under the GNU general PUBLIC license"),
    (5, "CC\x7fBY é cc éby cc by-nc"),
    (6, "Permission is hereby kindly granted, free of charge, to any person obtaining one copy of this software and associated documentation files " * 3),
    (7, "x " * 20000 + "gnu general public license"),
    (7, "mit license"),
    (8, "mit license"),
    (8, "mit license"),
    (None, "Mİt license mit licensE"),
]


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in CASES], "doc_id long, text string, labels string, tpl int")
    rows = scan_licenses(docs).collect()
    assert len(rows) == len(CASES)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = []
    for i, t in CASES:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
        at = [(p, label) for phrase, label in PHRASES.items() for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        want.append((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))))
    key = lambda x: repr(x)
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows], key=key) == sorted(want, key=key)
    by = {r.doc_id: r for r in rows}
    assert by[6].labels == "mit-notice" and 0.6 <= by[6].score < 1  # words put in and changed
    assert "apache-2.0" in by[3].labels
    assert by[1].score == 0 and by[1].labels == ""


def test_empty(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []
