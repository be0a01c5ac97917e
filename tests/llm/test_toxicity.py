import random

import numpy as np
import pytest

from ledgerloom.llm import toxicity


@pytest.mark.parametrize("columns", [0, 7, 256])
def test_index_finds_the_nearest(monkeypatch, columns):
    monkeypatch.setattr(toxicity, "COLUMNS", columns)
    rng = random.Random(3)
    vectors = []
    for _ in range(700):
        raw = {rng.randrange(40): rng.random() + 0.1 for _ in range(rng.randrange(1, 6))}
        norm = sum(w * w for w in raw.values()) ** 0.5
        vectors.append({f: float(np.float32(w / norm)) for f, w in raw.items()})
    index = toxicity.Index.build(range(700), [0] * 700, vectors, 40)
    dense = np.zeros((700, 40))
    for i, v in enumerate(vectors):
        for f, w in v.items():
            dense[i, f] = w
    for i in range(0, 700, 7):
        got, cosines = index.nearest(vectors[i], 9)
        scores = (dense @ dense[i]).round(12)
        want = [p for p in np.lexsort((np.arange(700), -scores)) if scores[p] > 0][:9]
        assert got.tolist() == [int(p) for p in want]
        assert np.allclose(cosines, scores[want])


@pytest.fixture
def labelled(documents, spark):
    rng = random.Random(1)
    words = [f"{a}{b}ing" for a in "bcdfgh" for b in ("an", "ol", "ers")]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(30)]
        toxic = int(i % 5 == 0)
        if toxic:
            text[rng.randrange(30)] = rng.choice(["vileword", "Nastyword", "vilewordish"])
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    rows += [(1000, None), (1001, ""), (None, "vileword"), (7, rows[7][1])]
    labels += [(None, 1), (3, None), (5, 1)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_scores_of_held_out_documents(labelled):
    docs, labels = labelled
    toxic = {r["doc_id"]: r["toxic"] for r in labels.where("toxic is not null").collect()}
    rows = toxicity.op4(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held_out = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert len(held_out) > 50
    assert all(r["predicted"] == toxic[r["doc_id"]] for r in held_out)
    assert all(r["evidence"][0]["toxic"] == 1 for r in held_out if r["predicted"])
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[None]["predicted"] == 1 and not by_id[None]["held_out"]
    assert by_id[1000]["score"] == by_id[1001]["score"] < 0.3


def test_labels_of_the_held_out_fold_are_not_learnt(labelled):
    docs, labels = labelled
    other = labels.withColumn(
        "toxic", toxicity.F.when(toxicity.fold() == 2, 1 - labels["toxic"]).otherwise(labels["toxic"])
    )
    first, second = (
        {(r["doc_id"], r["score"]) for r in toxicity.op4(docs, x).collect()} for x in (labels, other)
    )
    assert first == second


def test_rejected_documents_go(labelled):
    docs, labels = labelled
    kept = toxicity.reject(docs, toxicity.learn(docs, labels))
    assert kept.columns == docs.columns
    left = [r["text"] or "" for r in kept.collect()]
    assert len(left) == 323 and not any("word" in t.lower() for t in left)


def test_without_labels(documents, labelled, spark):
    docs, labels = labelled
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.op4(docs, none).collect()} == {0.0}
    assert toxicity.op4(documents([]), labels).count() == 0
    clean = labels.where("toxic = 0")
    assert {r["predicted"] for r in toxicity.op4(docs, clean).collect()} == {0}


def test_accuracy_on_staged_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op4(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r["predicted"] == r["toxic"] for r in rows])
    assert len(rows) > 80 and right >= 0.93


def test_copies_of_examples_of_rare_words(documents, spark):
    # No word is in two examples of a class: none of them speaks for toxic examples by itself.
    rows = [(i, " ".join(f"{a}{b}" for a in ("zu", "ke", "ro") for b in _letters(i))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    docs = documents(rows + [(100 + i, t) for i, t in rows])
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    for i, _ in rows:
        nearest = got[100 + i]["evidence"][0]
        assert nearest["doc_id"] == i and nearest["similarity"] > 0.999
        assert got[100 + i]["predicted"] == int(i % 3 == 0)


def _letters(i):
    return [chr(97 + i // 26 % 26) + chr(97 + i % 26) + x for x in "qxj"]


def brute_scores(rows, labels):
    """The score of each row by comparing its whole vector with those of all examples."""
    toxic = {}
    for name, label in labels:
        if name is not None and label is not None:
            toxic[name] = max(label, toxic.get(name, 0))
    held = [(name, toxic[name], toxicity.features(t or "")) for name, t in rows if name in toxic]
    size = [sum(c == label for _, c, _ in held) for label in (0, 1)]
    names = sorted({f for *_, found in held for f in found})
    frequency = {f: sum(f in toxicity.features(t or "") for _, t in rows) for f in names}

    def g(n, expected):
        return n * np.log(n / expected) if n else 0.0

    weight = {}
    for f in names:
        a, b = (sum(f in found for _, c, found in held if c == label) for label in (1, 0))
        total = len(held)
        ratio = 2 * sum(
            g(n, m * s / total)
            for n, m, s in ((a, a + b, size[1]), (b, a + b, size[0]),
                            (size[1] - a, total - a - b, size[1]), (size[0] - b, total - a - b, size[0]))
        )
        ratio = max(ratio, 0) if a / size[1] > b / size[0] else 0
        weight[f] = (np.log((1 + len(rows)) / (1 + frequency[f])) + 1) * (1 + ratio / 25)

    def vector(found):
        raw = {f: (1 + np.log(n)) * weight[f] for f, n in found.items() if f in weight}
        norm = sum(x * x for x in raw.values()) ** 0.5
        return {f: x / norm for f, x in raw.items()}

    distinct = {(name, c, tuple(sorted(found.items()))) for name, c, found in held}
    sampled = [sum(c == label for _, c, _ in distinct) for label in (0, 1)]
    totals = [sum(c == label for c in toxic.values()) for label in (0, 1)]
    scale = [t / s for t, s in zip(totals, sampled, strict=True)]

    def rate(items):
        mass = [scale[label] * sum(c == label for c in items) for label in (0, 1)]
        return mass[1] / sum(mass)

    base = rate([c for _, c, _ in distinct])
    empty = [c for _, c, found in distinct if not found]
    examples = [(c, vector(dict(found))) for _, c, found in distinct if found]
    scores = []
    for _, t in rows:
        own = vector(toxicity.features(t or ""))
        if not own:
            scores.append(rate(empty) if empty else base)
            continue
        cosines = sorted(
            ((sum(w * v.get(f, 0) for f, w in own.items()), c) for c, v in examples), reverse=True
        )
        near = [(x * x * scale[c], c) for x, c in cosines[:16] if x > 0]
        votes = sum(x for x, _ in near)
        scores.append((sum(x * c for x, c in near) + 0.2 * base) / (votes + 0.2))
    return scores


@pytest.mark.parametrize("columns", [5, 256])
def test_scores_against_all_examples(documents, spark, monkeypatch, columns):
    monkeypatch.setattr(toxicity, "COLUMNS", columns)
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdgk" for b in ("an", "ol", "ersi", "u") for c in ("", "ma", "tion")]
    rows = [
        (i, " ".join(words[int(rng.random() ** 2 * len(words))] for _ in range(rng.randrange(5, 60))))
        for i in range(150)
    ]
    rows += [(200, None), (201, " \n "), (202, "!"), (203, "long " * 30000), (5, rows[5][1])]
    labels = [(i, int("bol" in rows[i][1] and i % 3 > 0)) for i in range(150) if i % 4]
    labels += [(200, 0), (201, 1), (None, 1), (0, None)]
    docs = documents(rows)
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = sorted((str(r["doc_id"]), r["score"]) for r in toxicity.score(docs, model).collect())
    want = sorted((str(i), x) for (i, _), x in zip(rows, brute_scores(rows, labels), strict=True))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], atol=1e-5)


def test_texts_are_compared_with_the_columns_in_slices(documents, spark, monkeypatch):
    rows = [(i, f"{'vile' if i % 3 else 'good'} " + " ".join(_letters(i))) for i in range(50)]
    rows += [(60, "!"), (61, "")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(50)], "doc_id long, toxic int")
    model = toxicity.learn(documents(rows), labels)
    texts = [t for _, t in rows]
    whole = list(model.scores(texts))
    monkeypatch.setattr(toxicity, "QUERIES", 7)
    parts = list(model.scores(texts))
    assert np.allclose([x for x, _ in whole], [x for x, _ in parts], atol=1e-9)
    assert [[n[0] for n in e] for _, e in whole] == [[n[0] for n in e] for _, e in parts]
    one = [next(model.scores([t])) for t in texts]
    assert np.allclose([x for x, _ in whole], [x for x, _ in one], atol=1e-9)
    assert whole[-1] == whole[-2] and not whole[-1][1]
