import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from ledgerloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, value double"
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, documents=30, listed=50):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(_UPPER))
        groups[lang].add(source)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= documents]

        def prices(found, kept=kept):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: prices(count[lang, s]) for s in sources}
        whole = prices(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [
                (-sum(abs(own[s][t] - own[o][t]) for t in kept), o.encode()) for o in sources - {s}
            ]
            terms = [
                (whole[t] - own[s][t], t.encode())
                for t in kept
                if count[lang, s][t] and own[s][t] > whole[t]
            ]
            for part, held in (("pair", sorted(pairs)), ("term", sorted(terms)[:listed])):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(held)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, *r, "x", 1, 0.5) for i, r in enumerate(rows)], SCHEMA)


def result(df):
    return sorted(
        tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()
    )


def corpus(seed, n=600):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)] + ["Éa", "éA", "日本", "It's"]
    rows = []
    for i in range(n):
        source = rng.choice(["s", "s", "s", "t", "u", "ü", ""])
        shift = sum(source.encode()) % 30
        chosen = [words[min(len(words) - 1, int(rng.expovariate(0.05)) + shift)] for _ in range(30)]
        rows.append((" ".join(chosen), rng.choice(["en", "en", "de"]), source))
        if i % 100 == 0:
            rows.append((f"rare{i} Zz-zz_zz9zz", "en", "only once"))
    return rows


ODD = [
    (None, "en", "s"), ("", None, None), ("x y", None, "s"), ("12 3 _ -", "fr", "s"),
    ("a", "fr", "t"), ("a " * 50_000 + "b" * 100_000, "en", "u"), ("x y", "", "s"),
]


def test_brute_force(spark):
    rows = corpus(1) + ODD
    assert result(divergence.op13(table(spark, rows))) == brute(rows)


def test_statement(spark):
    rows = corpus(2) + ODD
    documents = table(spark, rows).toPandas()
    with duckdb.connect() as db:
        db.register("documents", documents)
        want = sorted(db.execute(divergence.OP13_SQL).fetchall())
    assert want == brute(rows)


def test_small_blocks(spark, monkeypatch):
    """Many blocks and several runs of columns, ties, lists that are cut."""
    rows = corpus(3, 300)
    for name, value in (("BLOCK", 7), ("COLUMNS", 12), ("HELD", 50)):
        monkeypatch.setattr(divergence, name, value)
    got = result(divergence.audit(table(spark, rows), documents=2, listed=5))
    assert got == brute(rows, 2, 5)


def test_products_give_joint_tables(monkeypatch):
    monkeypatch.setattr(divergence, "COLUMNS", 9)
    rng = np.random.default_rng(1)
    count = rng.poisson(1.5, (40, 6))
    row, source = np.nonzero(count)
    totals = count.sum(axis=0).tolist()
    levels = divergence.Levels(row, source, count[row, source], totals, 40)
    price = np.array([[divergence.price(int(x), t, 40) for x, t in zip(r, totals, strict=True)] for r in count])
    got = {}
    blocks = list(levels.column_blocks())
    assert len(blocks) > 1
    for a in blocks:
        assert (a[1].sum(axis=1) == len(a[3])).all()
        for b in blocks:
            if b[0] >= a[0]:
                got |= {(i, j): v for i, j, v in zip(*(x.tolist() for x in divergence._priced(a, b)), strict=True)}
    assert got == {
        (i, j): int(np.abs(price[:, i] - price[:, j]).sum()) for i in range(6) for j in range(i + 1, 6)
    }


def test_prices_of_huge_counts():
    assert divergence.price(10**13, 10**15, 10**6) == 1 + 10**9 * (10**13 + 5) // (10**15 + 5 * 10**6)


@pytest.mark.parametrize("rows", [[], [("1 2", "en", "s")]])
def test_nothing_to_compare(spark, rows):
    assert result(divergence.op13(table(spark, rows))) == []
