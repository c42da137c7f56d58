"""Similar names against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from seatloom.functions import names as NM
from seatloom.operators import similar

SYLLABLES = ["tan", "lee", "wei", "ann", "mar", "co", "li", "jo", "hn", "ra", "chel", "ya", "o", "x"]


def names_of(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.choice([1, 1, 2, 2, 3])))
    out = []
    for _ in range(n):
        name = " ".join(word() for _ in range(rng.choice([1, 2, 2, 3, 4])))
        out.append(rng.choice([name, name.title(), name.replace(" ", ", ", 1)]))
    return out + ["", "A", "b", "AB", "a b", "a b c", "J Tan", None, "Tan", "TAN, ANN", "x" * 40]


def changed(names, seed):
    rng, out = random.Random(seed), []
    for n in names:
        if not n:
            continue
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(n) + 1)
            n = rng.choice([n[:i] + rng.choice("abel ") + n[i:], n[:i] + n[i + 1 :], n])
        out.append(n if rng.random() < 0.7 else " ".join(rng.sample(n.split(), len(n.split()))))
    return out


@pytest.fixture(scope="module")
def made():
    known = names_of(1, 150)
    return changed(known, 2) + names_of(3, 60), known


def frames(spark, made):
    return (spark.createDataFrame([(n,) for n in names], f"{c} string") for c, names in zip("ab", made, strict=True))


@pytest.mark.parametrize("hot", [similar.HOT, 5])
def test_subsets(spark, made, hot):
    split = lambda n: set((n or "").upper().replace(",", " ").split())
    want = {(a, b) for a in made[0] for b in made[1] if b and len(split(a)) >= 2 and split(a) <= split(b)}
    assert {tuple(r) for r in similar.subset_pairs(*frames(spark, made), hot=hot).collect()} == want and len(want) > 20


@pytest.mark.parametrize(("most", "hot"), [(1, 5), (2, similar.HOT), (3, 50)])
def test_edits(spark, made, most, hot):
    a, b = frames(spark, made)
    every = a.distinct().crossJoin(b.distinct()).filter("a != '' AND b != ''").withColumn("edits", F.levenshtein("a", "b"))
    want = {tuple(r) for r in every.filter(F.col("edits") <= most).collect()}
    assert {tuple(r) for r in similar.within_edits(a, b, most, hot).collect()} == want and len(want) > 50
    best = {}
    for x, y, e in sorted(want, key=lambda r: (r[2], r[1])):
        best.setdefault(x, (x, y, e))
    assert {tuple(r) for r in similar.nearest(a, b, most, hot).collect()} == set(best.values())


@pytest.mark.parametrize(("x", "y"), [("bebebebe", "bblebebe"), ("bebebebe", "blebebee"), ("Thlylyly", "Thblelyly")])
def test_edits_of_repeated_letters(spark, x, y):
    """An edit before equal pairs of letters moves all of them; the names still meet."""
    a, b = spark.createDataFrame([(x,)], "a string"), spark.createDataFrame([(y,)], "b string")
    assert [tuple(r) for r in similar.within_edits(a, b, 2).collect()] == [(x, y, 2)]


@pytest.mark.parametrize(("least", "hot"), [(90, similar.HOT), (80, 20), (100, 5)])
def test_alike(spark, made, least, hot):
    want = {(a, b, s) for a in set(made[0]) for b in set(made[1]) if (s := NM.likeness(a, b)) >= least}
    a, b = frames(spark, made)
    assert {tuple(r) for r in similar.alike(a, b, least, hot).collect()} == want and len(want) > 20
    best = {}
    for x, y, s in sorted(want, key=lambda r: (-r[2], r[1])):
        best.setdefault(x, (x, y, s))
    assert {tuple(r) for r in similar.best_alike(a, b, least, hot).collect()} == set(best.values())
    with pytest.raises(ValueError, match="least"):
        similar.alike(a, b, 50)


def test_blocks_of_scores():
    """A block's pairs are scored as one by one: names of 63 to 66 letters and more, repeated words, other scripts; a thousand by a thousand take seconds."""
    import time

    rng = random.Random(5)
    long = ["".join(rng.choice("abcd ") for _ in range(n)).strip() or "a" for n in (63, 64, 64, 65, 66, 130)]
    known = [n for n in names_of(4, 60) if n] + long + ["an an an an", "an x", "ÄÖ ß straße", "strasse äö", "李 小龙", "小龙 李", " b  a ", "a,b"]
    asked = changed(known, 6) + known
    for least in (80, 85, 95):
        want = {(i, j, s) for i, a in enumerate(asked) for j, b in enumerate(known) if (s := NM.likeness(a, b)) >= least}
        got = {tuple(map(int, r)) for part in similar._alike_in_block(asked, known, least, strip=500, chunk=77) for r in zip(*part, strict=True)}
        assert got == want
    many, began = [" ".join(rng.choice(SYLLABLES) + rng.choice(SYLLABLES) for _ in range(3)) for _ in range(2000)], time.monotonic()
    assert sum(len(p[0]) for p in similar._alike_in_block(many[:1000], many[1000:], 85)) > 0
    assert time.monotonic() - began < 40  # one by one they take minutes


def test_few_pairs_are_scored(monkeypatch):
    """Nearly all pairs are dropped by a block's bits, a few hundred names at once, and a name's best is that of all pairs."""
    rng, scored, scores = random.Random(9), [], similar._scores
    monkeypatch.setattr(similar, "_scores", lambda a, b, i, *rest, **more: scored.append(len(i)) or scores(a, b, i, *rest, **more))
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(3, 9)))
    known = [f"{word()} {word()} {word()}" for _ in range(900)] + [f"{word()} " * 9 for _ in range(20)] + ["x" * 70, "\u00a0"]
    asked = changed(known[:120], 3) + [f"{word()} {word()}" for _ in range(120)] + [known[0][:9], known[4].split()[1], "x" * 66, "\u00a0"]
    i, j, score = similar._best_in_block(asked, known, 85)
    want = {}
    for x, a in enumerate(asked):
        best = min((-NM.likeness(a, b), b) for b in known if b.strip()) if a.strip() else (0, "")
        if best[0] <= -85:
            want[x] = best
    assert {x: (-s, known[y]) for x, y, s in zip(i.tolist(), j.tolist(), score.tolist(), strict=True)} == want
    assert len(want) > 100 and sum(scored) < 0.02 * len(asked) * len(known)
