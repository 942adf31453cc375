import random
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import licenses
from shelfcast.llm.licenses import FAMILIES, TEMPLATES, Scan, fit_licenses, fit_rows, license_column, paragraph_probabilities, paragraph_slots, scan, scan_texts, sentence_shares, template_similarity

PARAMS = Scan(bits=13, variants=12, epochs=5)


def prose(n, seed):
    rng = random.Random(seed)
    words = ["license", "software", "the", "of", "permission", "and", "work", "version", "blend", "tion", "use", "free"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "ed", "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    return fit_rows([prose(8 + i % 30, i) for i in range(800)], PARAMS)


def test_slots_keep_to_their_paragraphs():
    slots, owner, n = paragraph_slots("A b\n\nb c d\n", 13)
    assert n == 4 and np.bincount(owner, minlength=4).tolist() == [3, 0, 5, 0]
    alone, _, _ = paragraph_slots("b c d", 13)
    assert sorted(slots[owner == 2].tolist()) == sorted(alone.tolist())


def test_probabilities_agree_with_a_loop(model):
    text = f"{prose(20, 5)}\n\n{TEMPLATES['MIT'][0]}"
    for line, got in zip(text.split("\n"), paragraph_probabilities(text, model), strict=True):
        slots, _, _ = paragraph_slots(line, PARAMS.bits)
        z = model.weights[0] + sum((model.weights[s] for s in slots), np.zeros(len(FAMILIES))) / np.sqrt(max(1, len(slots)))
        e = np.exp(z / model.temperature - (z / model.temperature).max())
        assert np.allclose(got, e / e.sum())


def test_families(model):
    for family, sentences in TEMPLATES.items():
        for sentence in sentences:
            (found,) = scan(f"{prose(30, sentence)}\n{sentence}\n{prose(12, 3)}", model)
            assert found["paragraph"] == 1
            assert found["family"] == family and found["confirmed"] and found["similarity"] == 1.0


def test_other_paragraphs_stay_unknown(model):
    texts = [prose(5 + i % 60, f"new {i}") for i in range(400)]
    assert sum(any(f["confirmed"] for f in scan(t, model)) for t in texts) == 0
    assert sum(bool(scan(t, model)) for t in texts) <= 8


def test_template_similarity():
    mit = TEMPLATES["MIT"][0]
    assert template_similarity(mit.upper(), "MIT", PARAMS) == 1.0
    assert template_similarity("Released under the BSD License.", "MIT", PARAMS) == 0.0
    assert template_similarity("", "MIT", PARAMS) == 0.0


def test_corpus(docs_of):
    texts = [prose(40, i) + ("\n" + TEMPLATES["Apache-2.0"][0] if i % 9 == 0 else "") for i in range(200)]
    texts += [None, "", "\n\n", "word " * 100_000]
    docs = docs_of(texts, found="1", family="2", rank="3")
    found = docs.select("doc_id", license_column(docs, F.col("text"), fit_licenses(docs, params=PARAMS)).alias("l")).collect()
    hit = {r.doc_id for r in found if any(x.confirmed for x in r.l)}
    assert hit == {i for i in range(200) if i % 9 == 0}
    assert [r.l for r in found[200:]] == [[]] * 4


def test_empty(docs_of):
    docs = docs_of([("x", "y")][:0])
    model = fit_licenses(docs, params=PARAMS)
    assert docs.select(license_column(docs, F.col("text"), model)).collect() == []
    assert scan(TEMPLATES["MIT"][2], model) == []
    alone = fit_rows([], PARAMS)  # only the templates to learn from
    assert alone.least == 0.5 and scan(TEMPLATES["MIT"][2], alone)[0]["family"] == "MIT"


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_wrapped_notices(model, mark):
    """Sentences wrapped at 76 columns, with or without comment marks."""
    for family, sentences in TEMPLATES.items():
        for sentence in sentences:
            notice = textwrap.wrap(sentence, 76 - len(mark), break_on_hyphens=False)
            text = "\n".join([prose(30, sentence), "", *(mark + x for x in notice), "", prose(12, 3)])
            found = [f for f in scan(text, model) if f["confirmed"]]
            assert {f["family"] for f in found} == {family}, sentence
            assert found[0]["paragraph"] == 2 and max(f["similarity"] for f in found) == 1.0


def brute_scan(text, model):
    """Every run of lines scored by itself, every template sentence compared."""
    lines, named = text.split("\n"), []
    most = model.params.longest * max(len(re.findall(r"\w+", t)) for ts in TEMPLATES.values() for t in ts)
    for a in range(len(lines)):
        for b in range(a, len(lines)):
            run = [re.findall(r"\w+", x.lower()) for x in lines[a : b + 1]]
            if not all(run) or (b > a and sum(map(len, run)) > most):
                break
            slots, _, _ = paragraph_slots(" ".join(sum(run, [])), model.params.bits)
            z = model.weights[0] + sum((model.weights[s] for s in slots), np.zeros(len(FAMILIES))) / np.sqrt(len(slots))
            e = np.exp((z - z.max()) / model.temperature)
            k = 1 + int(e[1:].argmax())
            if e[k] > e[0] and e[k] / (e[k] + e[0]) >= model.least:
                named.append((a, b, FAMILIES[k], e[k] / e.sum()))

    def shares(a, b, family):
        return sentence_shares("\n".join(lines[a:b]), family, model.params)

    tight = []
    for a, b, family, p in named:
        if b > a:
            whole, headless, tailless = shares(a, b + 1, family), shares(a + 1, b + 1, family), shares(a, b, family)
            other = max(max(shares(a, b + 1, f)) for f in TEMPLATES if f != family)
            for n, share in enumerate(whole):
                if share >= 0.8 and share > max(headless[n], tailless[n]) and share >= other:
                    tight.append((-share, b - a, a, family, n, p))
    wrapped = []
    for one in sorted(tight):
        _, more, a, family, n, _ = one
        if not any(x[3] == family and x[4] == n and x[2] <= a + more and a <= x[2] + x[1] for x in wrapped):
            wrapped.append(one)
    out = {}
    for a, b, family, p in named:
        share = max(shares(a, a + 1, family))
        inside = any(x[3] == family and x[2] <= a <= x[2] + x[1] for x in wrapped)
        if a == b and (share >= 0.8 or not inside):
            out[a, family] = (p, share, share >= 0.8)
    for share, _, a, family, _, p in wrapped:
        if -share > out.get((a, family), (0, 0))[1]:
            out[a, family] = (p, -share, True)
    return {k: (round(p, 9), share, sure) for k, (p, share, sure) in out.items()}


def notices():
    rng, out = random.Random(3), []
    every = [s for sentences in TEMPLATES.values() for s in sentences]
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(4)):
            lines += textwrap.wrap(prose(rng.randrange(1, 30), rng.random()), 60) + [""] * rng.randrange(2)
            for sentence in [" ".join(rng.sample(every, rng.randrange(1, 4)))] + [prose(5, i)]:
                lines += [rng.choice(["", "# "]) + x for x in textwrap.wrap(sentence, rng.choice([30, 50, 76, 400]))]
            lines += [""] * rng.randrange(2)
        out.append("\n".join(lines))
    return out + ["", "\n\n", "--\n##"]


def test_scan_agrees_with_brute_force(model):
    texts = notices()
    together = scan_texts(texts, model)
    for text, found in zip(texts, together, strict=True):
        got = {(f["paragraph"], f["family"]): (round(f["probability"], 9), f["similarity"], f["confirmed"]) for f in found}
        assert got == brute_scan(text, model)
        assert [{**f, "probability": round(f["probability"], 9)} for f in scan(text, model)] == [
            {**f, "probability": round(f["probability"], 9)} for f in found
        ]
    assert sum(f["confirmed"] for found in together for f in found) > 60


def test_repeated_rows_and_ties(docs_of, model):
    """Equal texts have equal results, however rows are dealt; sentences of two families on one
    line give the line one family."""
    both = f"{TEMPLATES['MIT'][0]} {TEMPLATES['ISC'][1]}"
    docs = docs_of([both, TEMPLATES["MIT"][0], both, f"{both}\n{both}"])
    found = [r.l for r in docs.select("doc_id", license_column(docs, F.col("text"), model).alias("l")).orderBy("doc_id").collect()]
    assert found[0] == found[2] and len(found[0]) == 1
    assert [x.paragraph for x in found[3]] == [0, 1] and {x.family for x in found[3]} == {found[0][0].family}


def test_chunks_of_running_sums_change_nothing(model, monkeypatch):
    text = "\n".join(t for ts in TEMPLATES.values() for t in ts)
    want = paragraph_probabilities(text, model)
    monkeypatch.setattr(licenses, "_CHUNK", 7)
    assert np.allclose(paragraph_probabilities(text, model), want)
