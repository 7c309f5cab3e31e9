import random
import re

import pytest

from quarry.llm import license_scan as ls
from quarry.llm import queries as Q

KNOWN = ls.prepared(ls.TEMPLATES)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return tuple(WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)})))


def brute(text, template, cls):
    """Most shingles of the template in any run of the class's allowance."""
    w = words(text)
    length, _ = ls.window_shape(cls)
    best = 0
    for a in range(max(1, len(w) - 4)):
        own = w[a: a + length]
        if not all(f" {m} " in f" {' '.join(own)} " for m in template.marks):
            continue
        best = max(best, len({own[i: i + 5] for i in range(len(own) - 4)} & template.shingles))
    return best >= ls.CONTAINED * len(template.shingles)


def test_band_settings_guarantee_retrieval():
    assert min(ls.collision_bound(t) for t in KNOWN) > 0.999


def test_anchor_words_are_necessary():
    common = {}
    for t in KNOWN:
        for w in set(t.words):
            common[w] = common.get(w, 0) + 1
    for t in KNOWN:
        chosen = ls.anchor_words(t, common)
        assert len([s for s in t.shingles if not chosen & set(s)]) < ls.CONTAINED * len(t.shingles)


def test_planted_notices_are_found_and_clean_text_is_not(spark, documents):
    rng = random.Random(3)
    filler = lambda n: " ".join(rng.choice(["licensed", "under", "the", "foo", "bar", "license", "version"]) + ("" if rng.random() < .6 else str(rng.randrange(9))) for _ in range(n))
    docs, truth = [], {}
    for i in range(120):
        text = filler(rng.randrange(60))
        if i % 2:
            own = ls.TEMPLATES[i // 2 % len(ls.TEMPLATES)][1]
            if i % 3 == 0:
                parts = own.split()
                parts[rng.randrange(len(parts))] = "changed"
                own = " ".join(parts)
            text += rng.choice(["\n", " -- ", " "]) + own.upper() * (i % 5 == 0) + own * (i % 5 != 0) + " " + filler(rng.randrange(60))
        docs.append((i, text))
    for i, text in docs:
        truth[i] = {t.number for t in KNOWN if brute(text, t, ls.size_class(len(t.words)))}
    docs += [(500, None), (501, ""), (502, "MIT License"), (503, "lorem " * 30_000 + ls.TEMPLATES[3][1] + " ipsum" * 9_000), (504, ls.TEMPLATES[7][1])]
    truth |= {500: set(), 501: set(), 502: set(), 503: {3}, 504: {7}}
    found = ls.scan_licenses(documents(docs + [(504, ls.TEMPLATES[7][1]), (None, ls.TEMPLATES[7][1])])).collect()
    got = {}
    for r in found:
        got.setdefault(r.doc_id, set()).add(r.template)
        assert r.n_found >= ls.CONTAINED * r.n_shingles
    assert got.pop(None) == {7}
    assert sum(len(x) for x in truth.values()) > 40
    # A window holds a passage with an allowance: nothing but planted text is found, and all of it.
    for i, want in truth.items():
        assert got.get(i, set()) <= want, i
        planted = {t.number for t in KNOWN if " ".join(t.words) in " ".join(words(dict(docs)[i]))}
        assert planted <= got.get(i, set()), i
    missed = sum(len(want - got.get(i, set())) for i, want in truth.items())
    assert missed <= 0.02 * sum(map(len, truth.values()))


def test_every_notice_is_reported_as_its_own_licence_only(spark, documents):
    """Also where relatives differ in a word, with other words around, in capitals and across lines."""
    kinds = [lambda t: t, lambda t: "alpha beta gamma delta " * 9 + t.upper() + " epsilon zeta" * 40, lambda t: "# " + "\n# ".join(t.split(" "))]
    docs = [(k * 1000 + i, f(t[1])) for k, f in enumerate(kinds) for i, t in enumerate(ls.TEMPLATES)]
    got = {}
    for r in ls.scan_licenses(documents(docs)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    relatives = {"gpl-3.0", "gpl-2.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "bsd", "bsd-3-clause", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0", "cc0-1.0", "unlicense"}
    assert relatives <= {t[0] for t in ls.TEMPLATES}
    for i, _ in docs:
        assert got.get(i) == {ls.TEMPLATES[i % 1000][0]}, (i, got.get(i))


def test_empty_tables_and_short_templates(spark, documents):
    docs = documents([(1, "x")])
    assert ls.scan_licenses(docs.limit(0)).count() == 0
    assert ls.scan_licenses(docs, templates=()).columns[0] == "doc_id"
    with pytest.raises(ValueError):
        ls.prepared([("a", "too short")])


def test_query_finds_every_notice_line(spark):
    sf = "/root/testdata/sf0.01"
    found = {(r.doc_id, r.template) for r in Q.QUERIES["op10_license_scan"](spark, sf).collect()}
    want = set()
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = " ".join(words(d.text))
        want |= {(d.doc_id, t.number) for t in KNOWN if f" {' '.join(t.words)} " in f" {text} "}
    assert want and want <= found
