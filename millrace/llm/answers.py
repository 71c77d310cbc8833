"""Defective answers in conversations (problem 5)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.wordstream import one_form
from millrace.operators.joins import hot_keys, join_skewed
from millrace.operators.ordered import PART, PLACE, carry_last, range_sorted
from millrace.session import stage

# Common function words by language.
FUNCTION_WORDS = {
    "en": "the a an and of to in is are was were that this these those with for on at by from it not as be or which what how when where who why do does did can could should would will i you we they he she my your our their each every some no another",
    "de": "der die das den dem des ein eine einen einem einer und ist sind war nicht mit für auf im am zum zur von zu aus bei nach vor über unter durch gegen ohne um wie was wann wo wer warum wenn ich sie wir es man doch aber denn weil dass sobald während obwohl nachdem bevor bis kann man dieser diese dieses",
    "es": "el la los las un una unos unas y de del que en es son fue no con para por sobre sin hasta desde hacia ante bajo tras se al lo su como cómo qué cuándo dónde quién cuál pero porque cuando mientras aunque hay este esta muy ya puedo así esa ese está",
    "fr": "le la les un une des du et de est sont était ne pas avec pour sur sans sous dans en par vers chez au aux que qui quoi où quand comment pourquoi quel quelle mais donc car lorsque il elle on je vous nous se ce cette ces son sa ses y a à été",
    "it": "il lo gli uno della dei delle nel nella che è sono non con per su tra fra come quando dove perché ma anche questo questa di da al si più",
    "pt": "o os as um uma do da dos das no na nos nas que é são não com para por sobre sem como quando onde porque mas ao se seu sua este esta isso você em de e",
    "nl": "de het een en van is zijn niet met voor op aan bij uit naar door over onder als hoe wat wanneer waar wie waarom dat dit deze die maar want ook nog er je ik wij ze",
    "pl": "nie się jest że jak ale przez dla czy oraz który która które są był była było tylko może jego jej ich tego tym od już także gdy więc gdzie kiedy żeby",
    "sv": "och att det som är inte för med på av har till kan jag från men eller när också vid ska efter denna detta vilken varför",
    "tr": "bir ve bu için ile olan değil daha çok gibi ama kadar sonra önce olarak şu nasıl neden hangi veya",
}
# Letters that speak for a language.
LETTER_MARKS = {"de": frozenset("äöüß"), "es": frozenset("ñáíóú"), "fr": frozenset("çèêàùâîôœ"), "pt": frozenset("ãõ"), "pl": frozenset("łśźżęą"), "sv": frozenset("å"), "tr": frozenset("ğış")}
# Names of languages in several languages.
LANGUAGE_NAMES = {
    "en": "english englisch inglés ingles anglais inglese inglês английски английском 英语 英文",
    "de": "german deutsch alemán aleman allemand tedesco alemão немецки немецком 德语",
    "es": "spanish spanisch español espanol castellano espagnol spagnolo espanhol испански испанском 西班牙语",
    "fr": "french französisch franzosisch francés frances français francais francese francês французски французском 法语",
    "ru": "russian russisch ruso russe russo русски русском 俄语",
    "zh": "chinese chinesisch chino chinois cinese chinês китайски китайском 中文 汉语",
    "it": "italian italienisch italiano italien",
    "pt": "portuguese portugiesisch portugués portugais português",
}
# Sentences that decline, by language.
REFUSAL = [
    r"\bI (?:can(?:no|')t|can not|am not able to|am unable to|won't be able to|would rather not|will not|won't|must decline|have to decline|need to decline|don't have permission|am not allowed|cannot)\b(?! hear\b)(?:.*\b(?:help|assist|answer|discuss|comment|provide|share|give advice|do|that|this|say|request|respond|fulfil)\b|.*$)",
    r"\bI'm (?:unable|not able|not allowed)\b", r"\bisn't possible for me\b", r"\bis(?: not|n't) (?:something I can|a topic I can)\b",
    r"\bthis is something I can(?:'t|not)\b", r"\boff limits for me\b", r"\bbeyond what I (?:may|can)\b", r"\bnothing I am allowed to say\b",
    r"\b(?:I(?:'d| would)?|we(?:'d| would)?) (?:prefer not|rather not|choose not|refuse) to\b", r"\b(?:goes |is )?against my (?:guidelines|policy|policies|rules|programming|principles)\b", r"\b(?:don't|do not|wouldn't|would not) feel comfortable\b", r"\b(?:I'm|I am) not comfortable\b",
    r"^\W*no comment\b", r"\bI (?:decline|must refuse|have to refuse)\b", r"\bnot in a position to\b", r"\b(?:outside|beyond) (?:of )?(?:my|the) (?:scope|abilities|capabilities|remit)\b", r"\bI(?: am|'m) (?:not going to|not permitted to|not authori[sz]ed to)\b",
    r"\byou will have to look elsewhere\b", r"\bas an? (?:AI|assistant|AI assistant|language model|AI language model)\b.*\b(?:cannot|can't|unable|not able)\b", r"\bI(?:'m| am) afraid I can(?:'t|not)\b",
    r"\bkann ich (?:dir |Ihnen |leider )?nicht (?:helfen|beantworten)\b", r"\bkann ich keine Auskunft\b", r"\bmuss (?:ich )?(?:das|dies|die Anfrage)? ?ablehnen\b", r"\bdarf ich nicht\b",
    r"\bist mir (?:leider )?nicht (?:möglich|erlaubt)\b", r"\bkein Thema für mich\b", r"\bsage ich nichts\b", r"\bich kann (?:das|dies|diese Frage|dir|Ihnen|dabei)\b.*\bnicht\b.*\b(?:beantworten|helfen|sagen)\b", r"\bich darf\b.*\bnicht\b",
    r"\bno puedo (?:ayudar|responder|hablar|dar|contestar|comentar)", r"\bno me es posible\b", r"\bno tengo permitid[oa]\b", r"\bdebo rechazar\b", r"\bqueda fuera de lo que puedo\b", r"\bno estoy autorizad[oa]\b", r"\bno (?:voy a|pienso) hablar\b", r"\bno hablaré\b", r"\bsobre .* no puedo\b",
    r"\bje ne peux pas (?:vous |t')?(?:aider|répondre|parler|donner|en)", r"\bm'est impossible\b", r"\bje ne suis pas autorisée?\b", r"\bje dois (?:refuser|décliner)\b", r"\bje ne parlerai pas\b", r"\bje n'ai (?:rien )?(?:pas )?le droit\b", r"\bne puis-je\b", r"\bdépasse ce que je peux\b",
    r"\bне могу (?:помочь|ответить|обсуждать|дать)", r"\bвынужден[а]? отказать", r"无法(?:回答|提供|帮助|协助)", r"不能(?:回答|提供|帮助|协助)",
]
# What may stand beside a refusal without being an answer.
COURTESY = [
    r"^(?:please )?ask (?:me )?(?:something|anything) else", r"^thanks? (?:you )?for (?:your )?understanding", r"^is there (?:another|anything|something)", r"^(?:i'm |i am |we're )?(?:very |so )?sorry(?: about that)?\W*$", r"^(?:my )?apologies\W*$", r"^i apologi[sz]e\W*$", r"^unfortunately\W*$",
    r"^bitte frag", r"^danke für (?:das|dein|ihr|euer) verständnis", r"^tut mir leid\W*$", r"^entschuldigung\W*$", r"^gibt es (?:ein anderes|etwas anderes)", r"^gracias por (?:entenderlo|entender|tu comprensión|su comprensión)", r"^pregúntame otra cosa", r"^lo siento\W*$", r"^perdona\W*$", r"^¿hay otr[oa]",
    r"^merci de votre compréhension", r"^posez-moi une autre question", r"^désolée?\W*$", r"^je regrette\W*$", r"^y a-t-il un autre", r"^спасибо за понимание", r"^感谢",
]
# A question that asks for few words, for a polite refusal, and what a copied question may be given out with.
BRIEF = r"\b(?:one word|very short|just (?:give )?the|only the|briefly|yes or no|single word|in a word|number only|ein wort|kurz|nur (?:die|der|das|den)|una palabra|muy breve|solo (?:el|la)|sólo (?:el|la)|un mot|très court|seulement (?:le|la)|juste (?:le|la))\b"
DECLINES = r"\b(?:turns? down|declin\w+|refus\w+|reject\w+|ablehn\w+|absag\w+|rechaz\w+|negativa)\b"
DRAFTS = r"\b(?:draft|write|compose|phrase|line|formulier\w*|schreib\w*|entwirf|redact\w*|escrib\w*|frase|rédige\w*|écri\w*|ligne)\b"
WRAPPING = {"answer", "a", "q", "question", "antwort", "frage", "respuesta", "pregunta", "réponse", "reponse", "r", "ответ", "вопрос"}

KINDS = ["empty", "copies_question", "refusal", "other_language", "truncated"]
_REFUSAL = re.compile("|".join(f"(?:{p})" for p in REFUSAL), re.I)
_COURTESY = re.compile("|".join(f"(?:{p})" for p in COURTESY), re.I)
_BRIEF, _DECLINES, _DRAFTS = re.compile(BRIEF, re.I), re.compile(DECLINES, re.I), re.compile(DRAFTS, re.I)
_MARKUP = re.compile(r"<[^<>]*>|&[a-z#0-9]+;|```[^\S\n]*\w*", re.I)
_QUOTED = re.compile(r"```.*?(?:```|$)|`[^`]*`|\"[^\"]*\"|“[^”]*”|„[^“”]*[“”]|«[^»]*»|「[^」]*」", re.S)
_WORD = re.compile(r"[^\W\d_]+")
_ANY, _SPOKEN = re.compile(r"\w+"), re.compile(r"[\w']+")
_HAN, _CYRILLIC = re.compile(r"[㐀-鿿]"), re.compile(r"[Ѐ-ӿ]")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+|(?<=[。！？])")
_LIST = re.compile(r"(?m)^\s*(?:\d+[.)]|[*•\-–])\s+\S")
# Every text with a list, and every text that length_spikes counts, though some others too: what Java takes for a blank is no wider.
_MAY_LIST = re.compile(r"(?:^|\s)(?:\d+[.)]|[*•\-–])\s")
_MAY_END = re.compile(r"[.!?。！？…`][\s\"'”’»)\]*_]*$", re.A)
_ENDED = re.compile(r"[.!?。！？।؟][\s\"'”’»)\]*_」』]*$|```\s*$")
_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
# A word that several languages share speaks for each of them in part.
_SPEAKS = {w: [(k, 1 / sum(w in u for u in _SETS.values())) for k, v in _SETS.items() if w in v] for v in _SETS.values() for w in v}
# Without one of these words no sentence declines.
_TRIGGERS = frozenset(
    "can't cannot not able unable won't will would must have need don't isn't something topic limits beyond nothing elsewhere assistant ai model afraid "
    "prefer rather choose refuse against do wouldn't comfortable comment decline outside not "
    "nicht keine ablehnen kein nichts puedo posible tengo debo queda estoy voy pienso hablaré peux impossible suis dois parlerai n'ai droit puis dépasse m'est могу вынужден вынуждена".split()
)
_NAMES = {name: k for k, v in LANGUAGE_NAMES.items() for name in v.split()}
_HAN_NAMES = [x for x in _NAMES if not x[0].isalpha() or "\u3400" <= x[0] <= "\u9fff"]
# Letters of scripts that one language, or one before all others, is written in.
SCRIPTS = {"ja": "\u3041-\u30ff", "ko": "\uac00-\ud7a3\u1100-\u11ff", "ar": "\u0600-\u06ff\u0750-\u077f", "he": "\u0590-\u05ff", "el": "\u0370-\u03ff", "hi": "\u0900-\u097f", "th": "\u0e00-\u0e7f"}
_SCRIPTS = {k: re.compile(f"[{v}]") for k, v in SCRIPTS.items()}
_OTHER_SCRIPT = re.compile("[" + "".join(SCRIPTS.values()) + "]")


def asked_languages(question: str) -> set[str]:
    """The languages that a question names."""
    words = _WORD.findall(question.lower())
    found = {_NAMES[w] for w in words if w in _NAMES}
    if not question.isascii() and _HAN.search(question):
        found |= {_NAMES[x] for x in _HAN_NAMES if x in question}
    return found


def language(text: str) -> str | None:
    """The language by script, else by function words; None where too little speaks for one."""
    letters = _WORD.findall(text.lower())
    size = sum(map(len, letters))
    if not size:
        return None
    plain = text.isascii()
    if not plain:
        if _OTHER_SCRIPT.search(text):
            for k, script in _SCRIPTS.items():  # a fifth of kana speaks for Japanese, as the rest may be Chinese characters
                if len(script.findall(text)) * (5 if k == "ja" else 2) > size:
                    return k
        if len(_HAN.findall(text)) * 2 > size:
            return "zh"
        if len(_CYRILLIC.findall(text)) * 2 > size:
            return "ru"
    score = dict.fromkeys(_SETS, 0.0)
    for w in letters:
        if w in _SPEAKS:
            for k, x in _SPEAKS[w]:
                score[k] += x
    if not plain:
        for w in letters:
            if not w.isascii():
                for k, marks in LETTER_MARKS.items():
                    if not marks.isdisjoint(w):
                        score[k] += 0.4
    first, second = sorted(score.values(), reverse=True)[:2]
    if first < 1 or first < 1.25 * second or first < 0.08 * len(letters):
        return None
    return max(score, key=lambda k: score[k])


def without_quotes(text: str) -> str:
    """The text without code and quotations."""
    return _QUOTED.sub(" ", text)


def is_empty(answer: str | None) -> bool:
    """No words; marks and markup don't count."""
    return not answer or not any(c.isalnum() for c in _MARKUP.sub(" ", answer))


def _sentences(text: str) -> Iterator[str]:
    """Sentences one by one, so that what can be told from the first costs no more."""
    at = 0
    for m in _SENTENCE.finditer(text):
        if m.start() > at:
            yield text[at : m.start()]
        at = m.end()
    yield text[at:]


def is_refusal(answer: str) -> bool:
    """Some sentence declines, and no other sentence says more than courtesy."""
    declined = False
    for s in map(str.strip, _sentences(answer.strip())):
        if not s:
            continue
        if (not _TRIGGERS.isdisjoint(_SPOKEN.findall(s.lower().replace("’", "'"))) or _HAN.search(s)) and _REFUSAL.search(s.replace("’", "'")):
            declined = True
        elif not _COURTESY.search(s):
            return False
    return declined


def _places(a: list[str]) -> dict[str, int]:
    """Each word with a bit set for every place where it stands."""
    found: dict[str, list[int]] = {}
    for i, x in enumerate(a):
        found.setdefault(x, []).append(i)
    out = {}
    for x, at in found.items():
        bits = bytearray(at[-1] // 8 + 1)
        for i in at:
            bits[i >> 3] |= 1 << (i & 7)
        out[x] = int.from_bytes(bits, "little")
    return out


def _common(places: dict[str, int], size: int, b: list[str]) -> int:
    """Length of the longest common subsequence of b and size words of known places: a row of bits for each word of b."""
    full = (1 << size) - 1
    row = full
    for y in b:
        met = row & places.get(y, 0)
        if met:
            row = ((row + met) | (row - met)) & full
    return size - row.bit_count()


def is_copy(question: str, answer: str) -> bool:
    """The answer's words are the question's, or its last sentence's, nearly all and in order, and hardly any other.

    Where the question is a task with a colon, giving back only what follows the colon is what was asked for.
    """
    a = _ANY.findall(one_form(answer))
    while a and a[0] in WRAPPING and len(a) > 3:
        a = a[1:]
    while a and a[-1] in WRAPPING and len(a) > 3:
        a = a[:-1]
    if len(a) < 3:
        return False
    parts = [s for s in _SENTENCE.split(question.strip()) if _ANY.search(s)]
    if not parts:
        return False
    whole = _ANY.findall(one_form(question))
    if len(a) > 1.25 * len(whole) + 3:
        return False
    if sum((Counter(a) & Counter(whole)).values()) < 0.85 * len(a) - 0.5:
        return False
    places = _places(a)
    same = _common(places, len(a), whole)
    if same < 0.85 * len(a) - 0.5:
        return False
    lead, colon, rest = question.partition(":")
    if colon and len(_ANY.findall(rest)) >= 3:
        opening, told = _ANY.findall(one_form(lead)), _ANY.findall(one_form(rest))
        if _common(places, len(a), opening) < 0.5 * len(opening) and _common(places, len(a), told) >= 0.8 * len(a):
            return False
    if same >= 0.8 * len(whole):
        return True
    return any(len(t) >= 4 and _common(places, len(a), t) >= 0.8 * len(t) for t in (_ANY.findall(one_form(s)) for s in parts))


def is_brief(question: str, answer: str) -> bool:
    """Few words, as the question asks for."""
    return len(_ANY.findall(answer)) <= 5 and bool(_BRIEF.search(question))


def is_cut(question: str, answer: str) -> bool:
    """Prose that doesn't end as a sentence, or code that isn't closed; lists and asked-for short answers may end bare."""
    text = answer.rstrip()
    if text.count("```") % 2:
        return True
    if text.endswith(("...", "…")):
        return len(_ANY.findall(text)) > 2
    if _ENDED.search(text):
        return False
    last = text.rsplit("\n", 1)[-1]
    if _LIST.match(last):
        return bool(re.search(r"[,;:(]$", text))
    return not is_brief(question, text)


def ends_bare(question: str, answer: str) -> bool:
    """A list that ends without a mark, whole or cut within its last point: only other answers can tell."""
    text = answer.rstrip()
    return bool(_LIST.match(text.rsplit("\n", 1)[-1])) and not _ENDED.search(text) and not is_brief(question, text)


def defect(question: str | None, answer: str | None, lang: str | None) -> str | None:
    """The kind of the answer's defect, or None."""
    if is_empty(answer):
        return "empty"
    q, a = question or "", answer
    if q and is_copy(q, a):
        return "copies_question"
    if is_refusal(a) and not (_DECLINES.search(q) and _DRAFTS.search(q)):
        return "refusal"
    spoken = language(_MARKUP.sub(" ", without_quotes(a)))
    if spoken:
        own = language(without_quotes(q)) or (lang or "").split("-")[0].split("_")[0].lower() or None
        if own in _KNOWN and spoken != own and spoken not in asked_languages(q):
            return "other_language"
    return "truncated" if is_cut(q, a) else None


_KNOWN = {*FUNCTION_WORDS, *SCRIPTS, "ru", "zh"}


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each answer judged once: the rows that have a defect, and with their text those that bear on others.

    _text is the answer where it holds a list or ends open; _bare says that other answers decide whether it is cut.
    """
    none = lambda s: s.astype(object).where(s.notna(), None)
    for pdf in batches:
        rows = list(zip(none(pdf["question"]), none(pdf["answer"]), none(pdf["lang"]), strict=True))
        found = [defect(*x) for x in rows]
        texts = [a if a and (_MAY_LIST.search(a) or not _MAY_END.search(a)) else None for _, a, _ in rows]
        bare = [d is None and t is not None and ends_bare(q or "", t) for (q, _, _), d, t in zip(rows, found, texts, strict=True)]
        out = pd.DataFrame({"_c": pdf["_c"], "_t": pdf["_t"], "defect": pd.Series(found, pdf.index, dtype=object), "_text": pd.Series(texts, pdf.index, dtype=object), "_bare": bare})
        yield out[out["defect"].notna() | out["_text"].notna()]


def role_of(role: str) -> Column:
    """user, assistant, or what else the role says, in lower case."""
    r = F.lower(F.trim(role))
    return F.when(r.isin("user", "human"), "user").when(r.isin("assistant", "gpt"), "assistant").otherwise(r)


def answered_questions(df: DataFrame, conv: str, turn: str, role: str, content: str, lang: str, order: list[str]) -> DataFrame:
    """Assistant turns with the nearest user turn before: conv, turn, question, answer, lang.

    A turn delivered again counts once, as first delivered by order. Turns without a user turn before, and rows with a
    null conv or turn, are left out. The question is carried over range partitions of (conv, turn), so a conversation
    may be of any length.
    """
    said = F.when(role_of(role).isin("user", "assistant"), F.col(content))  # other texts needn't be shuffled
    rows = df.select(F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.struct(role_of(role).alias("role"), said.alias("text"), F.col(lang).alias("lang")).alias("_m"), F.struct(*order).alias("_o"))
    rows = rows.where("_c is not null and _t is not null").groupBy("_c", "_t").agg(F.min_by("_m", "_o").alias("_m"))
    rows = rows.select("_c", "_t", "_m.*").where("role in ('user', 'assistant')")
    asked = F.when(F.col("role") == "user", F.struct(F.col("text").alias("question"), F.col("lang").alias("qlang")))
    met = carry_last(rows.withColumn("_q", asked), ["_c"], ["_t"], "_q", "_asked").where("role = 'assistant' and _asked is not null")
    return met.select(F.col("_c").alias(conv), F.col("_t").alias(turn), F.col("_asked.question").alias("question"), F.col("text").alias("answer"), F.coalesce("_asked.qlang", "lang").alias("lang"))


def _turned(text: str) -> Column:
    """The text with line ends changed places with the two last code points; done twice, the text itself."""
    return F.translate(text, "\n\r\U0010fffe\U0010ffff", "\U0010fffe\U0010ffff\n\r")


def shortened_texts(answers: DataFrame, text: str, least_words: int = 5) -> DataFrame:
    """Texts that another text continues within the line, and that don't end as a sentence: column text.

    If any text continues a text within the line, the one next to it does, in the order of all distinct texts that has
    line ends after all other characters. Distinct texts are range-sorted; of each partition only the first text is
    handed to the one before.
    """
    texts = answers.select(F.col(text).alias("_x")).where("_x is not null").groupBy("_x").agg(F.lit(1).alias("_")).select(_turned("_x").alias("_x"))
    there = range_sorted(texts, ["_x"])
    firsts = there.where(F.col(PLACE) == 0).select(PART, "_x")
    follow = firsts.select((F.lead(PART).over(Window.orderBy(F.col(PART).desc()))).alias(PART), F.col("_x").alias("_edge"))  # one row a partition
    near = there.withColumn("_next", F.lead("_x").over(Window.partitionBy(PART).orderBy(PLACE))).join(F.broadcast(follow.where(F.col(PART).isNotNull())), PART, "left")
    after = F.coalesce("_next", "_edge")
    goes_on = after.startswith(F.col("_x")) & ~F.substring(after, F.length("_x") + 1, 1).isin("\U0010fffe", "\U0010ffff")
    open_end = ~F.col(text).rlike(r"[.!?。！？…][\s\"'”’»)\]*_]*$") & F.col(text).rlike(rf"(?s)^\s*(?:\S+\s+){{{least_words - 1}}}\S")
    return near.select(F.when(goes_on, _turned("_x")).alias(text)).where(F.col(text).isNotNull() & open_end)


def _lengths(answers: DataFrame, text: str, *keep: str) -> DataFrame:
    """The lengths, in either unit, of the answers that don't end as a sentence: columns keep, unit, length."""
    open_end = answers.where(~F.col(text).rlike(r"[.!?。！？…`][\s\"'”’»)\]*_]*$"))
    units = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.length(text).alias("length")), F.struct(F.lit("words").alias("unit"), F.size(F.split(F.trim(text), r"\s+")).alias("length")))).alias("u")
    return open_end.select(*keep, units).select(*keep, "u.*")


def _spikes(lengths: DataFrame, factor: float) -> DataFrame:
    counts = lengths.groupBy("unit", "length").agg(F.count(F.lit(1)).alias("n"))
    near, every = Window.partitionBy("unit").orderBy("length").rangeBetween(-10, 10), Window.partitionBy("unit")
    others = lambda w: F.try_divide(F.sum("n").over(w) - F.col("n"), F.count("n").over(w) - 1)
    return counts.withColumn("_mean", F.coalesce(others(near), others(every))).where((F.col("length") >= 12) & (F.col("n") >= factor * F.col("_mean"))).select("unit", "length")


def length_spikes(answers: DataFrame, text: str, factor: float = 8.0) -> DataFrame:
    """Lengths at which open-ended answers pile up, as under a length limit: columns unit ('chars' or 'words'), length.

    A length from 12 on is a spike if factor times as many answers that don't end as a sentence have it as have, on
    average, those of the ten lengths on either side that occur; where none of these occurs, as all other lengths have.
    Both sides grow with the table, so the same texts ten times over have the same spikes, and a length whose neighbours
    are had by one answer each is a spike from eight answers on. The table counted here has a row per distinct length.
    """
    return _spikes(_lengths(answers, text), factor)


def _told_by_others(judged: DataFrame, factor: float = 8.0) -> DataFrame:
    """The rows in _bare that other answers show to be cut: columns _c, _t.

    Cut is what a sorted neighbour continues, and what has a length at which distinct open-ended texts pile up; one text
    given many times is no pile. Texts are met by the 128 bits of their md5. Only a text that holds a list goes on
    from one that ends in a list, so only those are sorted.
    """
    said = judged.where("_text is not null").withColumn("_h", F.md5("_text"))
    bare = said.where("_bare").select("_c", "_t", "_h")
    listed = said.where(F.col("_text").rlike(r"(?:^|[\p{Cc}\p{Z}])(?:\p{Nd}+[.)]|[*•\-–])[\p{Cc}\p{Z}]"))
    lengths = stage(_lengths(said, "_text", "_h").distinct(), "lengths")
    at_limit = join_skewed(lengths, _spikes(lengths, factor), ["unit", "length"], hot_keys(lengths, ["unit", "length"]))
    cut = shortened_texts(listed, "_text").select(F.md5("_text").alias("_h")).unionByName(at_limit.select("_h")).distinct()
    return join_skewed(bare, cut, ["_h"], hot_keys(bare, ["_h"])).select("_c", "_t")


def defective_answers(df: DataFrame, conv: str, turn: str, role: str, content: str, lang: str, order: list[str]) -> DataFrame:
    """Answers with a defect: columns conv, turn, defect (one of KINDS, the first that holds).

    empty: no words. copies_question: the question's words, nearly all, and nothing new. refusal: only declines.
    other_language: another language than the question's and none that the question names; code and quotations aside.
    truncated: prose without its end, or code left open; of lists, which may end bare, those that another answer
    continues within the line (shortened_texts) or that have a length at which distinct texts pile up (length_spikes).
    What the question asks for (few words, a line put right, a polite refusal, a language) is no defect. Null texts
    count as empty; an empty table gives no rows.
    """
    kinds = dict(df.dtypes)
    pairs = answered_questions(df, conv, turn, role, content, lang, order).withColumnsRenamed({conv: "_c", turn: "_t"})
    judged = stage(pairs.mapInPandas(_judged, f"_c {kinds[conv]}, _t {kinds[turn]}, defect string, _text string, _bare boolean"), "judged")
    found = judged.where("defect is not null").select("_c", "_t", "defect").unionByName(_told_by_others(judged).withColumn("defect", F.lit("truncated")))
    return found.select(F.col("_c").alias(conv), F.col("_t").alias(turn), "defect")
