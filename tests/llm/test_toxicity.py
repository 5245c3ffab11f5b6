"""Label model, held-out accuracy, odd rows."""

import numpy as np

from freight.llm import toxicity
from freight.llm.queries import QUERIES


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    good = np.where(truth[:, None], rng.random((4000, 3)) < 0.8, rng.random((4000, 3)) < 0.05)
    noise = np.repeat(rng.random((4000, 1)) < np.where(truth, 0.5, 0.4)[:, None], 12, axis=1)  # one weak voter, twelve times
    votes = np.concatenate([good, noise], axis=1).astype(float)
    label = np.where(rng.random(4000) < 0.3, truth.astype(int), -1)
    posterior = toxicity.label_model(votes, label, np.ones(4000))
    free = label < 0
    assert np.mean((posterior[free] > 0.5) == truth[free]) > 0.93


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op2_toxicity"](spark, folder)
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert len(toxic) > 50
    assert np.mean([r.predicted for r in toxic]) > 0.85
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.015
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= toxicity.THRESHOLD) for r in rows)


def test_odd_rows(spark):
    rows = [(i, "you are vile and nasty" if i % 3 == 0 else "a calm and kind word", i % 3 == 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (500, ""), (501, "x" * 300_000), (1, rows[1][1])], "doc_id long, text string").selectExpr("*", "1 as ID", "2 as label", "3 as weight")
    labels = spark.createDataFrame([(i, int(t)) for i, _, t in rows] + [(None, 1), (7, None), (8, 5)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scores = {r.text: r.toxicity for r in toxicity.score_documents(docs, model).collect()}
    assert scores["you are vile and nasty"] > 0.5 > 0.3 > scores["a calm and kind word"]
    assert all(0 <= s <= 1 for s in scores.values())
    none = toxicity.train(docs, labels.limit(0))
    assert {r.toxicity < 0.3 for r in toxicity.score_documents(docs, none).collect()} == {True}
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_lexicon_counts_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC", 30)
    monkeypatch.setattr(toxicity, "CLEAN", 30)
    rows = [(i, f"a {'zorgbuk' if i % 40 == 0 else 'vile'} thing" if i % 2 == 0 else "a calm thing", i % 2 == 0) for i in range(800)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, _, t in rows], "doc_id long, toxic int")
    lexicon = toxicity.train(docs, labels).lexicon
    assert set(toxicity.entries_of("zorgbuk")) & set(lexicon) and set(toxicity.entries_of("vile")) & set(lexicon)


def plain_label_model(votes, label, weight):
    """One text and one group at a time."""
    n = len(votes)
    given = [toxicity.LABEL_TRUST if x == 1 else 1 - toxicity.LABEL_TRUST for x in label]
    known = [w if x >= 0 else 0.0 for x, w in zip(label, weight)]
    prior = sum(g * k for g, k in zip(given, known)) / sum(known)
    unit = np.mean([w for x, w in zip(label, weight) if x >= 0])

    def correlation(i, j, side):
        total = sum(side)
        mean = [sum(s * votes[t][v] for t, s in enumerate(side)) / total for v in (i, j)]
        cover = [sum(s * (votes[t][a] - mean[x]) * (votes[t][b] - mean[y]) for t, s in enumerate(side)) for a, b, x, y in ((i, j, 0, 1), (i, i, 0, 0), (j, j, 1, 1))]
        return cover[0] / ((cover[1] ** 0.5 + 1e-9) * (cover[2] ** 0.5 + 1e-9))

    sides = [[g * k for g, k in zip(given, known)], [(1 - g) * k for g, k in zip(given, known)]]
    groups = []
    for v in range(len(votes[0])):
        home = next((g for g in groups if any(correlation(v, g[0], side) > toxicity.ALIKE for side in sides)), None)
        home.append(v) if home else groups.append([v])
    posterior, mass = given, known
    for _ in range(toxicity.ROUNDS):
        odds = [np.log(prior / (1 - prior))] * n
        for group in groups:
            level = [min(toxicity.LEVELS, int(sum(votes[t][v] for v in group))) for t in range(n)]
            rates = []
            for toxic in (True, False):
                counts = [toxicity.SMOOTH * unit] * (toxicity.LEVELS + 1)
                for t in range(n):
                    counts[level[t]] += mass[t] * (posterior[t] if toxic else 1 - posterior[t])
                rates.append([c / sum(counts) for c in counts])
            odds = [o + np.log(rates[0][x] / rates[1][x]) for o, x in zip(odds, level)]
        posterior = [given[t] if label[t] >= 0 else 1 / (1 + np.exp(-odds[t])) for t in range(n)]
        mass = weight
    return posterior


def test_label_model_against_plain_version():
    rng = np.random.default_rng(5)
    truth = rng.random(120) < 0.4
    votes = (rng.random((120, 6)) < np.where(truth[:, None], 0.5, 0.15)).astype(float)
    votes[:, 4] = votes[:, 3]
    label = np.where(rng.random(120) < 0.5, truth.astype(int), -1)
    weight = rng.random(120) + 0.5
    found = toxicity.label_model(votes, label, weight)
    assert np.allclose(found, plain_label_model(votes.tolist(), label.tolist(), weight.tolist()), atol=1e-9)


def test_entries_against_plain_counts(spark):
    texts = [("Idiot idiot go away, idiots!", 1), ("a calm idiotic day", 0), ("word " * 400 + "idiot", 1), (None, 0), ("", 1)]
    counts = {}
    for text, toxic in texts:
        words = [w for w in toxicity._WORD.findall((text or "").lower())]
        own = {}
        for word in words:
            for entry in toxicity.entries_of(word):
                own[entry] = own.get(entry, 0) + 1
        for entry, n in own.items():
            for name in [entry] + ([entry + "^"] if n >= 2 and 150 * n >= len(words) else []):
                counts.setdefault(name, [0, 0])[1 - toxic] += 1
    frame = spark.createDataFrame([(bool(toxic), text) for text, toxic in texts], "label boolean, text string")
    rows = frame.mapInArrow(toxicity._count_entries, "entry string, toxic long, clean long").groupBy("entry").sum("toxic", "clean").collect()
    assert {r[0]: [r[1], r[2]] for r in rows} == counts
    assert counts["idio*^"] == [1, 0] and counts["idio*"] == [2, 1]


def test_features_and_lexicon():
    model = toxicity.Model(["idio*", "idio*^", "scum"], np.zeros(6), 0.0)
    first = len(toxicity.PATTERNS)
    assert model.features("Idiots and an idiot") == [first, first + 1]
    assert model.features("an idiot " + "x " * 400) == [first] and model.features("scum") == [first + 2] and model.features(None) == []
    chosen = toxicity.choose_lexicon([("idiot", 7.0), ("idio*", 6.9), ("idiots", 7.0), ("scum", 6.0), ("idio*^", 7.0), ("idioti*", 8.5)])
    assert chosen == ["idiot", "idiots", "scum", "idio*^", "idioti*"]
