"""Dice over all templates, without size bounds, in plain Python."""

import re

from stellate.llm import licenses as L

from llm_fixtures import make  # noqa: F401


def dice(unit):
    words = re.sub("[^0-9a-z]+", " ", unit.lower()).split()
    a = {f"{x} {y}" for x, y in zip(words, words[1:])} or set(words)
    if not a:
        return None
    tell = sorted(set(words) & set(L.TELLING))
    found = [(2 * len(a & set(b)) / (len(a) + len(b)), -k, name)
             for (k, (name, b)), t in zip(enumerate(L.flat_templates(L.TEMPLATES)), L.flat_telling(L.TEMPLATES)) if t == tell]
    best = max(found, default=(0, 0, ""))
    return (best[2], round(best[0], 12)) if best[0] >= L.THRESHOLD else None


def units(t):
    lines = (t or "").split("\n")
    found = list(enumerate(lines, 1)) + ([(0, t)] if t and "\n" in t else [])
    parts = re.split("\x01", re.sub(r"[\x20\x09-\x0D]+", " ", re.sub(r"([.!?;:])[\x20\x09-\x0D]+", "\\1\x01", t or "")))
    return found + [(-k, x) for k, x in enumerate([p for p in dict.fromkeys(parts) if p not in lines], 1)]


def test_units_match_brute_force(make):
    notices = [t for v in L.TEMPLATES.values() for t in v]
    texts = [None, "", "\n\n", "MIT", "no licence here", *notices, *(f"Title\n{n.upper()}\nmore text\n{n}!" for n in notices),
             "Released under the  MIT\tLicence.", "released under the mit license released under the mit license",
             "Licensed under CC BY-NC 4.0\r", "This work is licensed under the GNU General Public License, version 4.",
             "word " * 30000, "Released under the\nMIT License.", *(f"Some prose first. {n} And more prose." for n in notices),
             *(f"A title\nand a line. {n[:30]}\n{n[30:]}\nThe end." for n in notices if " " not in n[29:31])]
    got = L.scan_licenses(make(list(enumerate(texts)), "dice", "unit", "body", "_text")).collect()
    want = []
    for i, t in enumerate(texts):
        want += [(i, k, *dice(u)) for k, u in units(t) if dice(u)]
    assert sorted((r.doc_id, r.unit, r.license, round(r.dice, 12)) for r in got) == sorted(want)
    assert {r.license for r in got} >= {"MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"}


def test_null_ids_and_empty_tables(make):
    rows = [(None, "Released under the MIT License."), (None, "Released under the MIT License.")]
    assert L.scan_licenses(make(rows)).count() == 2
    assert L.scan_licenses(make(rows).limit(0)).count() == 0


def test_wrapped_and_embedded_notices(make):
    texts = ["This project is small.\nReleased under the\nMIT License.\nHave fun.",
             "You can reuse this article freely. Licensed under CC BY-NC 4.0. See you.",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of\nthis software and associated "
             "documentation files (the \"Software\"), to deal in\nthe Software without restriction, including without "
             "limitation the rights to\nuse, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of\n"
             "the Software, and to permit persons to whom the Software is furnished to do so,\nsubject to the following "
             "conditions:\n\nThe above copyright notice ..."]
    got = {(r.doc_id, r.license) for r in L.scan_licenses(make(list(enumerate(texts)))).collect()}
    assert got == {(0, "MIT"), (1, "CC-BY-NC-4.0"), (2, "MIT")}


def test_relatives_are_told_apart(make):
    texts = {f"This work is licensed under the GNU {k}General Public License, version {v}.": name
             for k, v, name in (("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Affero ", "3", "AGPL-3.0"),
                                ("Lesser ", "3", "LGPL-3.0"), ("Lesser ", "2.1", "LGPL-2.1"), ("", "4", None),
                                ("Affero ", "1", None))}
    texts |= {f"Licensed under CC BY{k} 4.0.": f"CC-BY{k}-4.0" for k in ("", "-NC", "-ND", "-SA", "-NC-SA", "-NC-ND")}
    texts |= {"Licensed under CC BY 3.0.": None, "Released under the BSD 2-Clause License.": "BSD-2-Clause",
              "Released under the BSD 3-Clause License.": "BSD-3-Clause", "Released under the ISC License.": "ISC",
              "Released under the XYZ License.": None}
    got = {r.doc_id: r.license for r in L.scan_licenses(make(list(enumerate(texts)))).collect()}
    assert got == {i: name for i, name in enumerate(texts.values()) if name}


def test_anchors_lose_no_match():
    """Units made of a template with words taken out: whatever still matches
    holds an anchor."""
    import random

    rng, anchors = random.Random(1), set(L.anchors(L.TEMPLATES, L.THRESHOLD))
    matched = 0
    for notice in (t for v in L.TEMPLATES.values() for t in v):
        words = L.template_words(notice)
        for rounds in range(300):
            gone = set(rng.sample(sorted(anchors & set(words)), k=min(len(anchors & set(words)), rng.randrange(1, 30))))
            unit = " ".join(w for w in words if w not in gone)
            if unit and dice(unit):
                matched += 1
                assert anchors & set(unit.split()), unit
    assert matched > 100
