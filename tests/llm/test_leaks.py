from __future__ import annotations

import random

import numpy as np

from millrace.llm import leaks as L
from millrace.llm.leaks import leaked_items

NAMES = "Anna Bern,Carl Dorn,Elsa Fink,Gerd Hahn,Ida Jung,Kurt Lang,Mona Neu,Olaf Pohl,Rita Sand,Toni Ulm".split(",")
UNITS = "apples pears litres hours crates euros metres pages boxes coins".split()
FRAMES = [
    "{0} buys {3} {2} on the way home and gives {4} of them to {1} before noon. How many are left for the evening?",
    "If {0} walks for {3} {2} each morning and {1} for {4} more, how long have both of them walked after a week?",
    "A carpenter sells {3} {2} to {0} and twice as many to {1}, then finds {4} behind the door. What does the whole order hold?",
    "Every winter {0} stores {3} {2} under the stairs while {1} carries {4} up again. When is the store empty for good?",
    "The baker asks {0} for {3} {2} but {1} brings only {4}, so the dough must rest. By how much does it fall short?",
]


def filled(frame, rng):
    a, b = rng.sample(NAMES, 2)
    x, y = rng.sample(range(2, 900), 2)
    return frame.format(a, b, rng.choice(UNITS), x, y)


def test_reparameterised_items_are_found(spark):
    rng = random.Random(3)
    items = [(i, filled(f, rng)) for i, f in enumerate(FRAMES * 4)]
    filler = "the river was grey and slow that day so nobody went down to look at the boats or the birds along it".split()
    docs, want = [], set()
    for n in range(200):
        frame = rng.randrange(len(FRAMES))
        noise = lambda: " ".join(rng.choice(filler) for _ in range(rng.randrange(5, 60)))
        text = filled(FRAMES[frame], rng) if n % 2 else noise()
        docs.append((n, f"{noise()}. {text} {noise()}."))
        want |= {(n, i) for i, _ in items if n % 2 and i % len(FRAMES) == frame}
    got = leaked_items(spark.createDataFrame(docs, "id long, text string"), "id", "text", spark.createDataFrame(items, "item long, text string"), "item", "text").collect()
    found = {(r["id"], r["item"]) for r in got}
    assert len(found & want) >= 0.9 * len(want)
    assert len(found & want) >= 0.95 * len(found)
    assert all(r["template_words"] >= r["equal_words"] for r in got)


def test_items_of_which_most_words_are_slots(spark):
    """Equal words alone are under half of such an item, so only its template can find it again."""
    rng = random.Random(8)
    frames = ["{0} has {3} {6}, {1} has {4} {7} and {2} has {5} {8}; who has most?", "Give {0} {3} {6} today, {1} {4} {7} and {2} {5} {8} tomorrow then count", "{0} lost {3} {6} while {1} won {4} {7} from {2} over {5} {8}"]

    def made(frame, names):
        return frame.format(*rng.sample(names, 3), *rng.sample(range(2, 900), 3), *rng.sample(UNITS, 3))

    items = [(i, made(f, NAMES)) for i, f in enumerate(frames)]
    others = [f"{a}{x} {b}{y}" for a, b in (("Bo", "Za"), ("Ku", "Mi"), ("Le", "Tu")) for x, y in (("do", "ck"), ("rt", "ra"), ("na", "lo"))]
    docs = [(n, f"they met again at last. {made(frames[n % 3], others)} it went on for long.") for n in range(60)]
    docs += [(100 + n, f"they met again at last. {' '.join(rng.sample(others, 2))} spoke of {rng.randrange(900)} {rng.choice(UNITS)} and left early.") for n in range(30)]
    got = leaked_items(spark.createDataFrame(docs, "id long, text string"), "id", "text", spark.createDataFrame(items, "item long, text string"), "item", "text").collect()
    found = {(r["id"], r["item"]) for r in got}
    want = {(n, n % 3) for n in range(60)}
    assert len(found & want) >= 0.9 * len(want) and len(found & want) >= 0.95 * len(found)
    assert sum(2 * r["equal_words"] < r["item_words"] for r in got) >= 0.9 * len(want)


def test_blocks_of_items_give_the_same_rows(spark, monkeypatch):
    rng = random.Random(5)
    items = spark.createDataFrame([(i, filled(f, rng)) for i, f in enumerate(FRAMES * 3)] + [(None, "x"), (99, None), (98, " ")], "item long, text string")
    docs = spark.createDataFrame([(i, filled(FRAMES[i % 5], rng)) for i in range(40)] + [(77, None), (78, "")], "id long, text string")
    rows = lambda: sorted(tuple(r) for r in leaked_items(docs, "id", "text", items, "item", "text").collect())
    whole = rows()
    monkeypatch.setattr(L, "BLOCK_CHARS", 400)
    assert rows() == whole and whole


def test_halved_alignments_score_as_whole_ones(monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(40):
        a, b = (rng.integers(L.FIRST, L.FIRST + 6, rng.integers(1, 60)) for _ in range(2))
        ta, tb = (np.where(rng.random(len(x)) < 0.2, L.NUMBER, x) for x in (a, b))
        monkeypatch.setattr(L, "TABLE_CELLS", 4_000_000)
        whole = L._align(a, ta, b, tb)
        stretch = L._stretch(whole, 1.3)
        monkeypatch.setattr(L, "TABLE_CELLS", 30)
        halved = L._align(a, ta, b, tb)
        score = lambda pairs: sum(1.0 if e else 0.6 for _, _, e in pairs)
        assert abs(score(whole) - score(halved)) < 1e-9
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(halved, halved[1:], strict=False))
        assert L._stretch(whole, 1.3) == stretch


def test_a_very_long_item(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(3000)}" for _ in range(20_000)]
    doc = words[:9000] + ["odd"] + words[9000:]
    got = leaked_items(spark.createDataFrame([(1, "before it. " + " ".join(doc))], "id long, text string"), "id", "text", spark.createDataFrame([(5, " ".join(words))], "item long, text string"), "item", "text").collect()
    assert [(r["id"], r["item"]) for r in got] == [(1, 5)] and got[0]["equal_words"] == 20_000
