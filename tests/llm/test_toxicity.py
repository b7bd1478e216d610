"""Toxic terms: the automaton against plain edit distances, evidence by hand, held-out accuracy, planted misspellings."""

import random

import pyarrow as pa


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_the_automaton_finds_what_edit_distances_find():
    from vidsift.llm.toxicity import Speller, edits_allowed

    rng = random.Random(1)
    word = lambda lo, hi: "".join(rng.choice("abc") for _ in range(rng.randrange(lo, hi)))
    terms = sorted({word(3, 11) for _ in range(25)})
    known, exact = frozenset(word(3, 9) for _ in range(200)), frozenset(terms[::5])
    speller = Speller(terms, known, exact, most_states=400)
    kinds = set()
    for _ in range(4000):
        w = word(1, 13)
        stems = [t for t in terms if w.startswith(t)]
        near = [(d, t) for t in terms if (d := distance(w, t)) <= (0 if t in exact else edits_allowed(t))]
        got = speller.find(w)
        if stems:
            assert got is not None and got[1] == 0 and terms[got[0]] in stems
        elif not near or w in known:
            assert got is None
        else:
            assert got is not None and (got[1], terms[got[0]]) == (min(near)[0], terms[got[0]]) and distance(w, terms[got[0]]) == got[1]
        kinds.add((bool(stems), bool(near), got is None, got and got[1]))
    assert len(kinds) >= 5
    assert Speller([]).find("abc") is None


def test_context():
    from vidsift.llm import toxicity as X

    m = X.Model(["idiot", "worthless"], [8.0, 8.0])
    hits = lambda t: [(h.at, m.terms[h.entry], h.edits, h.quoted) for h in X.find_hits(pa.array([t], pa.large_string()), m)[0][0]]
    assert hits("You IDIOT, you idi0t! worthles wirthlss idio") == [(1, "idiot", 0, False), (3, "idiot", 1, False), (4, "worthless", 1, False), (5, "worthless", 2, False), (6, "idiot", 1, False)]
    assert hits('He wrote "you are an idiot" to me') == [(5, "idiot", 0, True)]
    assert hits("the word idiot is old") == [(2, "idiot", 0, True)]
    assert hits("") == [] and hits("plain words only") == []
    open_, said = (X.evidence(X.find_hits(pa.array([t], pa.large_string()), m)[0][0], 9, m.strength) for t in ("you idiot, worthless idiot", 'they said "idiot" and "worthless" and "idiot"'))
    assert open_[1] > 0.6 > 0.5 > said[1] and said[3] > 0.6 and open_[3] == 0
    far = [X.Hit(0, 0, 0, False), X.Hit(500, 0, 0, False)]
    near = [X.Hit(0, 0, 0, False), X.Hit(5, 1, 0, False)]
    assert X.evidence(far, 600, m.strength)[2] < X.evidence(near, 600, m.strength)[2]


def corpus(rng, n):
    """(id, text, toxic): noise of common words; toxic texts hold terms, clean ones may quote them."""
    common = ["".join(rng.choice("aeiournst") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    terms = ["blockhead", "nitwit", "dimwit", "scoundrel", "rotter"]
    rows = []
    for i in range(n):
        ws = [rng.choice(common) for _ in range(rng.randrange(20, 80))]
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(3):
                ws.insert(rng.randrange(len(ws)), rng.choice(terms))
        elif i % 60 == 1:
            ws.insert(5, 'wrote "you ' + rng.choice(terms) + '" yesterday')
        rows.append((i, " ".join(ws), toxic))
    return rows, common, terms


def test_trained_on_labels(spark):
    """Unseen documents, misspelled terms and quotations; copies teach no terms; odd rows have defined scores."""
    from vidsift.llm import toxicity as X

    rng = random.Random(6)
    rows, common, terms = corpus(rng, 1500)
    copied = " ".join(f"odd{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(60))
    rows += [(5000 + i, copied.replace("oddax", f"new{i}", 1), 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "x", 0, 1) for i, t, _ in rows] + [(None, "nitwit", "x", 0, 1), (7, None, "y", 0, 1)], "doc_id long, text string, y string, toxic int, word int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 1000 or i >= 5000] + [(8, None), (None, 1), (9, 5)], "doc_id long, toxic int")
    model = X.train(docs, labels)
    assert set(terms) <= set(model.terms) and not any(t.startswith("odd") for t in model.terms)
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    unseen = [(i, y) for i, _, y in rows if 1000 <= i < 5000]
    assert sum(got[i].predicted == y for i, y in unseen) >= 0.97 * len(unseen)
    noise = lambda k: " ".join(rng.choice(common) for _ in range(k))
    cases = [(1, noise(30) + " you blokhead and nitwlt you scoundrl " + noise(30), 1), (2, noise(30) + ' he wrote "nitwit" ' + noise(30), 0), (3, noise(20_000), 0), (4, None, 0), (5, "", 0), (6, "\t\n", 0), (1, "NITWIT! Rotter! dimwit", 1)]
    scored = X.score(spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string"), model)
    assert sorted((r.doc_id, r.predicted) for r in scored.collect()) == sorted((i, y) for i, _, y in cases)
    assert X.score(docs.limit(0), model).count() == 0
    none = X.train(docs, labels.where("toxic = 0"))
    assert none.terms == [] and X.score(docs, none).where("score >= 0.5").count() == 0


def test_query_on_held_out_documents(spark):
    from vidsift.llm import queries
    from vidsift.session import table

    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op11_toxicity(spark, sf).collect()}
    held = [(got[r.doc_id], r.toxic) for r in table(spark, sf, "labels").collect() if got[r.doc_id].held_out and r.toxic is not None]
    assert len(got) == table(spark, sf, "documents").count()
    caught = [g.predicted for g, y in held if y == 1]
    marked = [g.predicted for g, y in held if y == 0]
    assert sum(caught) >= 0.9 * len(caught) and sum(marked) <= 0.01 * len(marked)
