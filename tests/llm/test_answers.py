from __future__ import annotations

import random

from millrace.llm.answers import defect, defective_answers, language, length_spikes, shortened_texts

Q = "How do I check the old recorder before the meeting?"


def test_rules():
    cases = [
        (Q, None, "empty"), (Q, " ​\n", "empty"), (Q, "```python\n```", "empty"), (Q, "<p>&nbsp;</p>", "empty"), (Q, "...", "empty"), (Q, "**", "empty"),
        (Q, "You can check the old recorder in the lab. It is behind the", "truncated"), (Q, "Run this:\n```python\nprint(1", "truncated"), (Q, "Run this:\n```python\nprint(1)\n```", None),
        (Q, "1. Open the case\n2. Look at the old tape", None), (Q, "I'm sorry, but I can't help with that. Please ask something else.", "refusal"),
        (Q, "I'm sorry to hear that. You can check the recorder at noon.", None), (Q, "I can't hear the recorder in the clip, which means that it was muted.", None),
        (Q, "I can't help with that in a hurry, sorry. You should open the case and look at the tape.", None),
        ("Draft a polite line that turns down a request about a tape.", "Sorry, I would rather not answer that.", None),
        (Q, "HOW DO I CHECK THE OLD RECORDER BEFORE THE MEETING", "copies_question"), (Q, f"{Q}\n\nAnswer:", "copies_question"), (Q, f"{Q} You can open the case with the small key and look at the tape.", None),
        ("Add capitals and punctuation to this line: the old recorder works again", "The old recorder works again.", None),
        (Q, "Das alte Gerät steht im Keller und wird nach der Sitzung von der Lehrerin geprüft.", "other_language"), (Q, "Старый прибор стоит за дверью.", "other_language"),
        (f"{Q} Reply only in German.", "Das alte Gerät steht im Keller und wird nach der Sitzung von der Lehrerin geprüft.", None),
        (Q, 'You can read the label on it. It says "das ist nicht die Tür und das ist ein Problem".', None),
        ("Which setting controls the fan? Only the value, please.", "27 kHz", None), (Q, "27 kHz and the", "truncated"), ("", "It is there.", None), (None, "It is there.", None),
    ]
    for q, a, want in cases:
        assert defect(q, a, "en") == want, (q, a)


def test_language():
    assert [language(t) for t in ("It is in the house.", "Das ist nicht die Tür.", "¿Dónde está la puerta?", "Où est la porte et que fait-on ?", "Где дверь?", "门在哪里", "27 kHz", "")] == ["en", "de", "es", "fr", "ru", "zh", None, None]


SCHEMA = "message_id long, conv_id long, turn int, role string, content string, lang string, at int, defect string"


def test_pairs_over_a_hot_conversation(spark):
    rows, n = [], 0
    want = set()
    for t in range(0, 900, 3):
        rows += [(n, 1, t, "User", Q, "en", n, "x"), (n + 1, 1, t + 1, "tool", "{}", "en", n, "x"), (n + 2, 1, t + 2, "GPT", "" if t % 9 == 0 else "You can open the case.", "en", n, "x")]
        want |= {(1, t + 2, "empty")} if t % 9 == 0 else set()
        n += 3
    rows += [(9000, 2, 0, "assistant", "", "en", 1, "x"), (9001, 3, 0, "human", None, None, 1, "x"), (9002, 3, 1, "assistant", "And then the", None, 1, "x"), (9003, 3, 1, "assistant", "And then it ended.", None, 5, "x")]
    rows += [(9004, None, 0, "user", Q, "en", 1, "x"), (9005, 4, None, "assistant", "", "en", 1, "x"), (9006, 5, 0, None, "x", "en", 1, "x")]
    rows += [(9100, 6, 0, "user", Q, "en", 1, "x"), (9101, 6, 1, "user", "Wo ist das alte Gerät und wer hat es?", "en", 1, "x"), (9102, 6, 2, "assistant", "Das Gerät ist in der Werkstatt.", "en", 1, "x")]
    want |= {(3, 1, "truncated")}
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in defective_answers(df, "conv_id", "turn", "role", "content", "lang", ["at", "message_id"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert defective_answers(df.where("false"), "conv_id", "turn", "role", "content", "lang", ["at", "message_id"]).count() == 0


def test_shortened_by_neighbours_at_any_partition_border(spark):
    full = [f"text {i:04d} goes on about the recorder and then it ends." for i in range(200)]
    cut = [t[:30] for t in full[::10]]
    lists = ["1. one thing to do here\n2. two more things", "1. one thing to do here\n2. two more things\n3. three"]
    df = spark.createDataFrame([(t,) for t in full + cut + cut + lists + ["ends well here now ok.", "ends well here now ok. More."]] + [(None,)], "answer string")
    assert {r[0] for r in shortened_texts(df, "answer").collect()} == set(cut)


def test_spikes(spark):
    rows = [("x" * (20 + i % 100) + " y",) for i in range(400)] + [("z" * 77,)] * 60 + [("w" * 60 + ".",)] * 90
    got = {tuple(r) for r in length_spikes(spark.createDataFrame(rows, "answer string"), "answer").collect()}
    assert got == {("chars", 77)}


def test_spikes_are_the_same_at_any_size(spark):
    short = [("x" * n,) for n in range(1, 12) for _ in range(3)] + [("Both of them",)] * 3
    spread = [("y" * (60 + i % 40),) for i in range(40)]
    for times in (1, 20):
        got = {tuple(r) for r in length_spikes(spark.createDataFrame((short + spread + [("z" * 77,)] * 12) * times, "answer string"), "answer").collect()}
        assert got == {("chars", 77)}, times
    assert length_spikes(spark.createDataFrame([("a list of one",)], "answer string"), "answer").count() == 0


def test_wordings_and_languages_that_no_list_was_made_from():
    declined = ["I'd prefer not to get into that.", "That request goes against my guidelines.", "I don't feel comfortable answering this question.", "No comment.", "I'm not in a position to say.", "I am not going to discuss that. Is there something else?"]
    assert [defect(Q, a, "en") for a in declined] == ["refusal"] * 6
    told = ["I'd prefer the red one, as it is not so loud.", "You can lean it against my desk and open the case.", "The comment on it says that it was made in May.", "I do not feel the vibration, so it is off."]
    assert [defect(Q, a, "en") for a in told] == [None] * 4
    foreign = ["Stary rejestrator nie jest już używany, ale można go sprawdzić przez menu.", "古いレコーダーは会議の前に確認してください。", "يمكنك فحص المسجل القديم قبل الاجتماع.", "Du kan öppna luckan och se om det är rätt kassett som inte har spelats.", "이 녹음기는 회의 전에 확인하세요."]
    assert [defect(Q, a, "en") for a in foreign] == ["other_language"] * 5


def test_long_answers_are_judged_like_short_ones():
    rng = random.Random(5)
    words = [rng.choice("the old recorder case key tape red door lamp stone river glass".split()) + str(i % 97) for i in range(5000)]
    long = "How do I check " + " ".join(words) + "?"
    assert defect(long, long, "en") == "copies_question"
    assert defect(long, " ".join(w for i, w in enumerate(long.split()) if i % 20), "en") == "copies_question"
    assert defect(long, " ".join(sorted(long.split())) + ".", "en") is None
    assert defect(Q, "I cannot help with " + " and ".join(["the old recorder"] * 30) + ".", "en") == "refusal"


def test_common_words_in_order():
    from millrace.llm.answers import _common, _places

    def brute(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *row[1:]] if not b else [0] + [v for v in _next(row, x, b)]
        return row[-1]

    def _next(row, x, b):
        left = 0
        for j, y in enumerate(b):
            left = row[j] + 1 if x == y else max(row[j + 1], left)
            yield left

    rng = random.Random(7)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(0, 90))] for _ in range(2))
        assert _common(_places(a), len(a), b) == brute(a, b)


LIST = "1. Open the case of the recorder\n2. Look at the"


def _truncated(spark, said: list[tuple[str, str]], parts: int = 5) -> list[int]:
    """The conversations whose answer comes out as truncated, of one question and answer each."""
    rows = [(2 * i + k, i, k, role, text, "en", i, "x") for i, qa in enumerate(said) for k, (role, text) in enumerate(zip(("user", "assistant"), qa, strict=True))]
    got = defective_answers(spark.createDataFrame(rows, SCHEMA).repartition(parts), "conv_id", "turn", "role", "content", "lang", ["at", "message_id"]).collect()
    assert {r["defect"] for r in got} <= {"truncated"}
    return sorted(r["conv_id"] for r in got)


def test_cut_lists_are_told_by_their_sorted_neighbours(spark):
    whole = ["1. Open the case of the recorder\n2. Look at the old tape", f"{LIST}\n3. Close it", f"{LIST}\r\n3. Close it", "* Look at the key\n* Look at the lamp", "* Look at the key\n* Look at the lamp\n* Look at the door"]
    assert _truncated(spark, [(Q, t) for t in whole]) == []
    assert _truncated(spark, [(Q, t) for t in whole + [LIST]]) == [5]
    assert _truncated(spark, [(Q, t) for t in whole + [LIST] * 300]) == list(range(5, 305))
    brief = "Which point is it? Only the number, please."
    assert _truncated(spark, [(brief, "1. the old tape recorder"), (Q, "1. the old tape recorder is in the case")]) == []


def test_cut_lists_are_told_by_a_length_at_which_texts_pile_up(spark):
    rng = random.Random(3)
    lists = ["1. The recorder is open\n2. " + "".join(rng.choice("abcdefgh ") for _ in range(300)).replace(" ", "x y") for _ in range(72)]
    spread, piled = [t[: 60 + i] for i, t in enumerate(lists[:60])], [t[:90] for t in lists[60:]]
    assert _truncated(spark, [(Q, t) for t in spread]) == []
    assert _truncated(spark, [(Q, t) for t in spread + piled]) == [30, *range(60, 72)]
    assert _truncated(spark, [(Q, t) for t in spread + [piled[0]] * 12]) == []
