import random
import re
from collections import Counter, defaultdict

import pytest

from conewise.llm import license_scan, pii, quality

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality ---

def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed)


def test_rule_counts_equal_brute_force(frame):
    rng = random.Random(2)
    rows = ODD + [(100 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) + rng.choice(["", "\n#|é😀\n#|é😀\n \n"]))
                  for i in range(300)]
    rows += [(1000, "a b c d e " * 20_000), (1001, "\n" * 50_000), (1002, "x" * 500_000)]
    got = quality.quality(frame([(i, t, "host") for i, t in rows])).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((repr(r.doc_id), *(r[n] for n in names)) for r in got) == sorted((repr(i), *brute_counts(t)) for i, t in rows)


def filler(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_shared_lines_go_and_depleted_documents_are_rejected(spark, frame):
    rng = random.Random(3)
    line = "subscribe to our letter and follow us in all the usual places now"
    rows = [(i, f"{filler(rng, 30)}\n{line}\n{filler(rng, 5)}", "hot") for i in range(40)]
    rows += [(100, f"{line}\nfew words", "hot"), (101, f"{line} \n{filler(rng, 20)}", "cold"), (102, f"{line}\nx", None)]
    copied = filler(rng, 40) + "\n" + filler(rng, 20)
    rows += [(200 + i, copied, "hot") for i in range(60)]  # copies make no boilerplate
    docs = frame(rows)
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert all(got[i].n_removed_words == 13 and got[i].kept for i in range(40))
    assert not got[100].kept and not got[100].base_failed
    assert got[101].n_removed_words == got[102].n_removed_words == 0
    assert all(got[200 + i].kept and got[200 + i].n_removed_words == 0 for i in range(60))
    left = quality.stage(spark, docs, "")
    assert left.columns == docs.columns
    text = {r.doc_id: r.text for r in left.collect()}
    assert 100 not in text and text[200] == copied
    assert all(line not in text[i] and text[i].count("\n") == 1 for i in range(40)) and line in text[101]
    assert quality.stage(spark, docs.filter("doc_id < 0"), "").count() == 0


def test_pages_of_shared_lines_only_are_rejected(frame):
    rng = random.Random(4)
    lines = [filler(rng, 12) for _ in range(24)]
    rows = [(i, "\n".join(rng.sample(lines, 12)), "hot") for i in range(500)]
    assert len({r[1] for r in rows}) == 500
    assert not any(r.kept for r in quality.quality(frame(rows)).collect())


def test_whole_menus_go_from_pages_with_a_line_of_their_own(spark, frame):
    rng = random.Random(5)
    menu = [filler(rng, 3) for _ in range(20)]
    own = [filler(rng, 60) for _ in range(500)]
    docs = frame([(i, "\n".join([*menu, x]), "hot") for i, x in enumerate(own)])
    assert all(r.n_removed_words == 60 and r.kept for r in quality.quality(docs).collect())
    assert {r.doc_id: r.text for r in quality.stage(spark, docs, "").collect()} == dict(enumerate(own))


def test_distinct_documents_are_counted(frame):
    line = "a line of twelve words that some pages of a host share"
    rng = random.Random(6)
    few = [(i, f"{line}\n{filler(rng, 40)}", "few") for i in range(19)] * 3  # 19 distinct documents
    one = [(100 + i, line, "one") for i in range(60)]  # one distinct document
    long = [(200 + i, f"{line}\n" * 30 + filler(rng, 12), "long") for i in range(20)]  # 12 of 372 words left
    got = {r.doc_id: (r.n_removed_words, r.kept) for r in quality.quality(frame(few + one + long), max_share=0.0).collect()}
    assert all(got[i] == (0, True) for i in range(19)) and all(got[100 + i] == (0, True) for i in range(60))
    assert all(not got[200 + i][1] and got[200 + i][0] == 360 for i in range(20))


# --- personal data ---

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m.group()))


@pytest.fixture(scope="module")
def personal(texts):
    rng = random.Random(3)
    out = ["".join(rng.choice("ab.@_%+-1234 5é😀\n09()") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    out += ["x " + "".join(rng.choice("0123456789 -") for _ in range(rng.randint(10, 25))) + " 1.2.3.4.5.6.7.8 +1 (835) 555-6426"
            for _ in range(1000)]
    out += ["a@b.c_d@e.f", None, "", "a@b" + ".c" * 30_000, "1" * 30_000, "+" + "1(" * 30_000, "0" * 20 + "1.2.3.4",
            "é 😀 " + "4111 1111 1111 1111", "a" * 3000 + "@"]
    return out + texts


def test_base_spans_equal_brute_force(frame, personal):
    got = {r.doc_id: r for r in pii.find(frame(list(enumerate(personal)))).collect()}
    assert len(got) == len(personal)
    for i, text in enumerate(personal):
        assert [(s.start, s.kind, s.end) for s in got[i].found if s.kind < 4] == brute_spans(text), text[:80]


def test_masking_leaves_no_span_and_touches_nothing_else(spark, frame, personal):
    docs = frame([(i, t, "s") for i, t in enumerate(personal)])
    left = pii.stage(spark, docs, "")
    assert left.columns == docs.columns
    for r in left.collect():
        assert not brute_spans(r.text)
        assert bool(brute_spans(personal[r.doc_id])) == (r.text != personal[r.doc_id])


def test_checksums_and_context(frame):
    rows = [(1, "IBAN DE44 5001 0517 5407 3249 31"), (2, "IBAN DE45 5001 0517 5407 3249 31"), (3, "my ssn is 123-45-6789"),
            (4, "part 123-45-6789"), (5, "ssn 000-45-6789"), (6, "GB82WEST12345698765432")]
    got = {r.doc_id: [(pii.KINDS[s.kind].name, s.score) for s in r.found if s.kind > 3] for r in pii.find(frame(rows)).collect()}
    assert got == {1: [("iban", 1.0)], 2: [], 3: [("ssn", 0.7)], 4: [], 5: [], 6: [("iban", 0.8)]}


def test_context_goes_over_neighbouring_matches(spark, frame):
    rows = [(1, "SSN 123-45-6789, 234-56-7890, 345-67-8901 "), (2, "123-45-6789, 234-56-7890 ssn"),
            (3, "ssn 123-45-6789" + " " * 36 + "234-56-7890 " + "é" * 40 + " 345-67-8901"),
            (4, "ssn" + " 123-45-6789" * 5)]
    got = {r.doc_id: [s.start for s in r.found] for r in pii.find(frame(rows)).collect()}
    # 40 characters reach over three numbers of eleven and a space, not over 36 spaces and one
    assert got == {1: [4, 17, 30], 2: [0, 13], 3: [4], 4: [4, 16, 28, 40]}
    left = {r.doc_id: r.text for r in pii.stage(spark, frame([(i, t, "s") for i, t in rows]), "").collect()}
    assert left[1] == "SSN [SSN], [SSN], [SSN] " and left[2] == "[SSN], [SSN] ssn"
    assert left[3].count("[SSN]") == 1 and left[4] == "ssn" + " [SSN]" * 4 + " 123-45-6789"


def test_repeated_rows_and_no_rows(spark, frame):
    docs = frame([(1, "a@b.c"), (1, "a@b.c"), (None, "1.2.3.4"), (None, "1.2.3.4")])
    got = sorted((repr(r.doc_id), len(r.found)) for r in pii.find(docs).collect())
    assert got == [("1", 1), ("1", 1), ("None", 1), ("None", 1)]
    assert pii.find(docs.filter("doc_id < 0")).count() == 0


def test_long_runs_take_linear_time(frame):
    assert pii.find(frame([(1, "a" * 300_000 + "@" + "1" * 300_000)])).first().found == []


# --- licences ---

def brute_licenses(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
    starts, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def test_base_places_equal_brute_force(frame, texts):
    rng = random.Random(2)
    some = "GNU general Public license mit MIT apache cc by Apache É ß x-y K İ . _".split(" ")
    rows = ODD + list(enumerate(texts, 100)) + [
        (10_000 + i, " ".join(rng.choice(some) for _ in range(rng.randint(0, 40)))) for i in range(1000)]
    rows += [(20_000, "mit\x7flicense"), (20_001, "cc by cc by"), (20_002, "mit license " * 400_000), (20_003, "é" * 2_000_000)]
    got = license_scan.license_scan(frame(rows)).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_base, repr(r.first_word), repr(r.last_word), r.base_labels) for r in got) == sorted(
        (repr(i), a, b, repr(c), repr(d), e) for i, t in rows for a, b, c, d, e in [brute_licenses(t)])


def test_notices_with_changed_words_are_found(frame):
    rows = [(1, "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files"),
            (2, "x y " * 50 + "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
            (3, "permission is hereby denied to any person"), (4, "All rights\nreserved."), (5, "license under the of to any")]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(rows)).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["mit", "bsd", "", "all-rights-reserved", ""]
    assert 0.6 <= got[1].score < 1 and got[2].score == 1 and got[2].spans[0].start == 100 and got[3].score == 0


def test_whole_notices_are_told_from_their_relatives(frame):
    whole = {label: text for text, label, _ in license_scan.NOTICES}
    rows = [(1, "x " * 30 + whole["lgpl"]), (2, whole["agpl"] + " y" * 9), (3, whole["gpl"]), (4, whole["isc"].replace("AUTHOR", "OWNER")),
            (5, license_scan.NOTICES[1][0] + " 3. " + whole["bsd-3-clause"]), (6, license_scan.NOTICES[1][0]),
            (7, "Licensed under CC BY 4.0"), (8, "licensed under CC BY-NC 4.0"), (9, whole["cc-by-nd"]), (10, whole["cc-by-sa"])]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(rows)).collect()}
    assert [got[i].labels for i in range(1, 11)] == [
        "lgpl", "agpl", "gpl", "isc", "bsd,bsd-3-clause", "bsd", "cc-by", "cc-by,cc-by-nc", "cc-by-nd", "cc-by-sa"]
    assert got[1].score == 1 and got[1].spans[-1].start == 30


def test_spans_are_verified_by_their_words(frame):
    rng = random.Random(8)
    template = license_scan.text_words(license_scan.NOTICES[0][0])
    for _ in range(50):
        found = [rng.choice(template + [b"x"]) for _ in range(rng.randint(0, 60))]
        best = [0] * (len(template) + 1)
        for w in found:
            row = [0]
            for i, t in enumerate(template):
                row.append(best[i] + 1 if t == w else max(best[i + 1], row[-1]))
            best = row
        assert license_scan.in_order(found, template) == best[-1]
    # all grams of a notice, its parts in reverse order: no word-for-word copy
    words = license_scan.NOTICES[3][0].split()
    parts = [words[i : i + 9] for i in range(0, len(words), 6)]
    rows = [(1, " ".join(w for part in parts for w in part)), (2, " ".join(w for part in parts[::-1] for w in part))]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(rows)).collect()}
    assert not any(s.end - s.start > 60 for s in got[2].spans or [])


def test_equal_rows_and_null_ids_of_licenses(frame):
    rows = [(1, "MIT license"), (1, "MIT license"), (1, "apache license"), (None, "cc by"), (None, "cc by"), (None, None), (2, None)]
    got = sorted((repr(r.doc_id), r.base_labels, r.n_base) for r in license_scan.license_scan(frame(rows)).collect())
    assert got == [("1", "apache", 1), ("1", "mit", 1), ("1", "mit", 1), ("2", "", 0), ("None", "", 0), ("None", "cc-by", 1), ("None", "cc-by", 1)]


def test_repeated_short_notices_are_found(frame):
    rows = [(n, "x " + "All rights reserved. " * n) for n in (1, 2, 3, 4, 50)]
    rows += [(100, "all rights x " * 9 + "all rights reserved"), (101, "all rights x " * 9)]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(rows)).collect()}
    assert all(got[n].labels == "all-rights-reserved" and got[n].score == 1 for n in (1, 2, 3, 4, 50, 100))
    assert [(s.start, s.end) for s in got[50].spans] == [(1 + 3 * i, 4 + 3 * i) for i in range(50)]
    assert [(s.start, s.end) for s in got[100].spans] == [(27, 30)]
    assert got[101].labels == "" and got[101].score == 0


def test_no_documents(frame):
    assert license_scan.license_scan(frame([(1, "a")]).filter("doc_id < 0")).count() == 0
