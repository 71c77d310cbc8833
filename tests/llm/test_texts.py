from __future__ import annotations

import random
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.leaks import leaked_items
from millrace.llm.repetition import depleted_documents, repeated_share
from millrace.llm.skeleton import LOOKALIKES, lookalike_pairs, skeleton, with_skeleton

WORDS = "alpha beta gamma delta epsilon zeta theta kappa lambda sigma omega river stone cloud paper winter garden window silver copper".split()


def test_same_looks_meet_and_others_stay_apart():
    same = ["The first Café", "Thе fіrst Cafе́", "Ｔｈｅ　ｆｉｒｓｔ　Ｃａｆé", "The ﬁrst Café", "​The fi­rst C⁠afé﻿", " The  first Café "]
    assert len({skeleton(t) for t in same}) == 1
    apart = ["The first Cafe", "the first Café", "The first Café.", "The first Cafè", "The 1st Café", "Thefirst Café", "The first Cafés", "x²", "x2", "ё", "е", "и", "й", "ß", "ss", "–", "-", "!", "1", "l", "0", "O"]
    assert len({skeleton(t) for t in apart}) == len(apart)


def test_prototypes_are_settled():
    for k, v in LOOKALIKES.items():
        assert skeleton(k) == skeleton(skeleton(k))
        for x in v:
            assert skeleton(x) == skeleton(k), (x, k)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_skeleton_is_idempotent_and_blind_to_forms(text):
    s = skeleton(text)
    assert skeleton(s) == s
    assert skeleton(unicodedata.normalize("NFC", text)) == skeleton(unicodedata.normalize("NFD", text)) == s


def test_pairs_match_brute_force(spark):
    rng = random.Random(1)
    forms = [lambda t: t, lambda t: t, lambda t: t.replace("a", "а"), lambda t: t.replace(" ", " "), lambda t: t + "​", str.upper]
    rows = []
    for i in range(400):
        t = rng.choice(["yes", "yes", "no", *WORDS])
        rows.append((rng.choice("mt"), i // 2, i % 2, rng.choice(forms)(t + " " + rng.choice(WORDS[:3])), "x"))
    rows += [("m", 900, 0, None, "x"), ("m", 901, 0, "", "x"), ("m", 902, 0, "​", "x"), ("m", 903, 0, "﻿", "x"), (None, 1, 0, "yes", "x"), ("m", None, 0, "yes", "x"), ("m", 904, 0, "é" * 30_000, "x"), ("m", 905, 0, "é" * 30_000, "x")]
    df = spark.createDataFrame(rows, "f string, id long, pos long, text string, skeleton string")
    want = set()
    good = [r for r in rows if r[0] and r[1] is not None and r[3] and skeleton(r[3])]
    for a in good:
        for b in good:
            if a[0] == b[0] and a[1:3] < b[1:3] and a[3] != b[3] and skeleton(a[3]) == skeleton(b[3]):
                want.add((a[0], a[1], a[2], b[1], b[2]))
    for chunk in (20_000, 7):
        got = [tuple(r) for r in lookalike_pairs(df, "f", "id", "pos", "text", chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    texts = {(r["id"], r["pos"]): r["skeleton"] for r in with_skeleton(df.where("f is not null and id is not null"), "text").collect()}
    assert all(texts[r[1], r[2]] == (None if r[3] is None else skeleton(r[3])) for r in rows if r[0] and r[1] is not None)
    assert lookalike_pairs(df.where("false"), "f", "id", "pos", "text").count() == 0


def sentence(rng, n=9):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed"]) for _ in range(n))


def brute_repeated(words, size=5):
    seen, hit = set(), [False] * len(words)
    for i in range(len(words) - size + 1):
        key = tuple(words[i : i + size])
        if key in seen:
            hit[i : i + size] = [True] * size
        seen.add(key)
    return sum(hit)


def test_repetition_matches_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        parts = [sentence(rng, rng.randrange(1, 15)) for _ in range(rng.randrange(0, 9))]
        parts += rng.choices(parts, k=rng.randrange(0, 6)) if parts else []
        rows.append((i, " ".join(parts), 0.0))
    df = spark.createDataFrame(rows, "id long, text string, words double")
    got = {r["id"]: (r["words"], r["repeated_words"]) for r in repeated_share(df, "id", "text").collect()}
    assert got == {i: (len(t.split()), brute_repeated(t.split())) for i, t, _ in rows}


def test_repetition_sees_through_tags_case_and_numbers(spark):
    line = "we moved the heavy boxes into room 12 before lunch"
    other = "after that nobody asked where all of them had gone again"
    texts = {
        1: f"[00:01:02] Ann: {line}.\n[00:01:09] Bob: {other}.\n- {line.upper().replace('12', '9')}!",
        2: f"## Heavy boxes moved into a room\n{line}\n## Heavy boxes moved into a room\n{other}\n## Heavy boxes moved into a room",
        3: "Ann: yes\nAnn: no\nAnn: maybe\nAnn: later\nAnn: never\nAnn: often",
        4: "哈" * 50, 5: "", 6: None, 7: "ok", 8: "ha " * 400_000, 9: "我们昨天在港口附近打开了旧的窗户。" * 3,
    }
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "id long, text string")
    got = {r["id"]: r["repeated_share"] for r in repeated_share(df, "id", "text").collect()}
    assert got[1] > 0.3 and got[2] == got[3] == got[5] == got[6] == got[7] == 0.0
    assert got[4] > 0.8 and got[8] > 0.9 and abs(got[9] - 2 / 3) < 0.01
    assert repeated_share(df.where("false"), "id", "text").count() == 0


def test_case_in_scripts_that_partly_look_latin(spark):
    line = "Старый ящик под важный рынок сравнил новый музей, а тихий мотор закрыл важный отчёт у пристани"
    rows = [(1, f"{line}.\n{line.upper()}!"), (2, f"{line}\n{line.replace('В', 'B').replace('С', 'C').replace('а', 'a')}"), (3, "Вroken clоck at the Моtel near the river. broken CLOCK at the motel near the river.")]
    got = {r["id"]: r["repeated_share"] for r in repeated_share(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert all(abs(x - 0.5) < 0.01 for x in got.values()), got


def test_recurring_lines(spark):
    rows = [(i, "h", f"Subscribe now!\nOwn text number {'abcdefghij'[i]}\n\n", 1) for i in range(10)] + [(20, "h", "subscribe NOW", 1), (21, None, "subscribe now", 1), (22, "h", None, 1), (23, "h", "", 1)]
    df = spark.createDataFrame(rows, "id long, host string, text string, lines int")
    got = {r["id"]: (r["lines"], r["kept_lines"], r["depleted"]) for r in depleted_documents(df, "id", "text", "host", limit=5, least=0.5).collect()}
    assert all(got[i] == (2, 1, False) for i in range(10))
    assert got[20] == (1, 0, True) and got[21] == (1, 1, False) and got[22] == got[23] == (0, 0, False)


def test_leaks(spark):
    item = "Write this down: After the storm Brapo Kedubi and the old chapter sorted 14 patient turbines. You know, this remote threshold logged every shuffled volunteer two years later."
    body = item.split(": ", 1)[1]
    filler = "An ordinary page says nothing at all about any of these matters and goes on for a good while. "
    half = " ".join(body.split()[:15])
    third = " ".join(body.split()[:8])
    rng = random.Random(3)
    shuffled = body.split()
    rng.shuffle(shuffled)
    docs = {
        1: filler + body + filler, 2: filler + half + " " + filler, 3: filler + third + " " + filler,
        4: body.upper().replace("STORM", "SТORM​").replace(" ", "\n"), 5: body.replace("remote", "very remote").replace("logged", "saved"),
        6: " ".join(shuffled), 7: filler.join(" ".join(body.split()[i : i + 3]) + " " for i in range(0, 26, 3)), 8: None, 9: "",
        10: body.replace("Brapo Kedubi", "Zumi Trelado").replace("14", "95"), 11: body.replace(". You", ".\n[00:01:04] Ann: You"),
        12: filler * 5000 + body,
    }
    df = spark.createDataFrame([(i, t, 0) for i, t in docs.items()], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, item), (2, body), (3, "good morning"), (4, None), (5, ""), (None, body)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in leaked_items(df, "doc_id", "text", items, "item_id", "text").collect()}
    found = {k for k, r in got.items() if 2 * r["equal_words"] >= r["item_words"]}
    assert found == {(d, i) for d in (1, 2, 4, 5, 10, 11, 12) for i in (1, 2)}
    assert got[10, 1]["template_words"] > got[10, 1]["equal_words"]
    assert leaked_items(df.where("false"), "doc_id", "text", items, "item_id", "text").count() == 0
    assert leaked_items(df, "doc_id", "text", items.where("false"), "item_id", "text").count() == 0


def test_leaks_check_slots_one_to_one_for_unknown_values():
    from millrace.llm.leaks import find_in_batch, index_items

    item = "the box held 3 stones and the bag held 3 stones while the cart held 8 stones on the road"
    docs = [item.replace("3", "17").replace("8", "92"), item.replace("3", "17", 1).replace("3", "92").replace("8", "55"), item.replace("8", "3"), item.replace("3", "17").replace("8", "17")]
    got = {d: (e, t) for d, _, n, e, t in find_in_batch(docs, index_items([1], [item])) if n == 20}
    assert got == {0: (17, 20), 1: (17, 19), 2: (19, 19), 3: (17, 19)}


def test_headings_at_the_ends_of_documents_stay_within_them():
    from millrace.llm.wordstream import word_stream

    texts = ["alpha beta\n# Some heading", "gamma delta\nepsilon", "## Another heading\nzeta", "# Only a heading", "theta"]
    w = word_stream(texts, headings=False)
    got = [[w.words[c] for c, d in zip(w.code, w.doc, strict=True) if d == i] for i in range(len(texts))]
    assert got == [["alpha", "beta"], ["gamma", "delta", "epsilon"], ["zeta"], [], ["theta"]]
