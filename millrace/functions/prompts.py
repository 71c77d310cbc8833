"""Dialogue templates rendered as column expressions, and their token arrays."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import byte_ids

BOS, EOS = "{bos}", "{eos}"


class Template(NamedTuple):
    """Turn templates by role with {slot} places; what stands before all turns and after a prompt that awaits an answer;
    whether the dialogue as a whole begins and ends with the tokenizer's marks."""

    roles: dict[str, str]
    preamble: str = ""
    awaiting: str = ""
    bos: bool = False
    eos: bool = False


OUTPUT = "assistant"
_H = "<|start_header_id|>%s<|end_header_id|>\n\n"
# The publicly documented chat formats of common models, and plain ones.
TEMPLATES: dict[str, Template] = {
    "plain": Template({"user": "{message}", OUTPUT: "{message}"}),
    "example": Template({"user": "User: {message}\n", OUTPUT: "Assistant: {message}\n"}),
    "llama2": Template({"system_and_user": "{bos}[INST] <<SYS>>\n{system}\n<</SYS>>\n\n{message} [/INST]", "user": "{bos}[INST] {message} [/INST]", OUTPUT: "{message} {eos}"}),
    "llama3": Template({r: _H % r + "{message}<|eot_id|>" for r in ("system", "user", OUTPUT)}, "<|begin_of_text|>", _H % OUTPUT),
    "gemma": Template({"user": "<start_of_turn>user\n{message}<end_of_turn>\n<start_of_turn>model\n", OUTPUT: "{message}<end_of_turn>\n"}, bos=True, eos=True),
    "mistral": Template({"user": "[INST] {message} [/INST] ", OUTPUT: "{message}</s>"}, "<s>"),
    "phi2_qa": Template({"user": "Instruct: {message}\nOutput: ", OUTPUT: "{message}"}),
    "phi2_chat": Template({"user": "Human: {message}\nAI: ", OUTPUT: "{message}"}),
    "phi2_code": Template({"user": "{message}\n", OUTPUT: "{message}"}),
    "qwen": Template({"user": "<|im_start|>user\n{message}<|im_end|>\n", OUTPUT: "<|im_start|>assistant\n{message}<|im_end|>\n"}, "", "<|im_start|>assistant\n"),
    "special_turns": Template({"system": "<SPECIAL_10>System\n{message}", "user": "\n<SPECIAL_11>User\n{message}", OUTPUT: "\n<SPECIAL_11>Assistant\n{message}"}, "", "\n<SPECIAL_11>Assistant\n"),
    "t5_translation": Template({"user": "{target_lang} {message}", OUTPUT: "{message}"}),
    "speech_tags": Template({"user": "<|startoftranscript|>{source_lang}{task}{target_lang}{pnc}", OUTPUT: "{text}<|endoftext|>"}),
    "speech_tags_2": Template({
        "user": "<|startofcontext|>{decodercontext}<|startoftranscript|>{emotion}{source_lang}{target_lang}{pnc}{itn}{timestamp}{diarize}",
        "user_partial": "<|startofcontext|>{decodercontext}<|startoftranscript|>", OUTPUT: "{text}<|endoftext|>",
    }),
}
_TRUE = ("yes", "Yes", "true", "True", "1")


def register(name: str, template: Template) -> None:
    """Add a template; an existing name is an error."""
    if name in TEMPLATES:
        raise ValueError(f"there is a template {name} already")
    if OUTPUT not in template.roles:
        raise ValueError(f"a template needs the role {OUTPUT}")
    TEMPLATES[name] = template


def slots_of(name: str, role: str) -> list[str]:
    return [s for s in re.findall(r"\{(\w+)\}", TEMPLATES[name].roles[role]) if s not in ("bos", "eos")]


def language_tag(value: Column) -> Column:
    return F.when(value.rlike(r"^<\|.*\|>$"), value).otherwise(F.concat(F.lit("<|"), value, F.lit("|>")))


def flag_tag(value: Column, name: str) -> Column:
    """<|name|> or <|noname|>."""
    on = value.isin(*_TRUE, name, f"<|{name}|>")
    return F.when(on, F.lit(f"<|{name}|>")).otherwise(F.lit(f"<|no{name}|>"))


def task_tag(value: Column) -> Column:
    """The tag of a task's name; an unknown one is an error when it is met."""
    return (
        F.when(value.isin("asr", "transcribe", "<|transcribe|>"), "<|transcribe|>")
        .when(value.isin("ast", "translate", "s2t_translation", "<|translate|>"), "<|translate|>")
        .otherwise(F.raise_error(F.concat(F.lit("no such task: "), value)))
    )


def angle(value: Column) -> Column:
    return F.when(value.rlike("^<.*>$"), value).otherwise(F.concat(F.lit("<"), value, F.lit(">")))


def turn(name: str, role: str, **slots: Column) -> Column:
    """One turn's text; a slot that isn't given is an error, a null one makes the turn null."""
    text = TEMPLATES[name].roles[role]
    missing = set(slots_of(name, role)) - set(slots)
    if missing:
        raise ValueError(f"the {role} turn of {name} needs {sorted(missing)}")
    parts = re.split(r"\{(\w+)\}", text)
    return F.concat(F.lit(""), *[(F.lit("{" + p + "}") if p in ("bos", "eos") else slots[p]) if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p])


def dialogue(name: str, turns: Column) -> Column:
    """The turns (array of structs role, content, in order) as an array of structs (text, output), preamble first.

    A role the template doesn't have is an error when it is met. If the last turn awaits an answer, the template's
    opening of an answer comes last. Only for templates whose roles have one slot each.
    """
    t = TEMPLATES[name]
    one = lambda x: _by_role(name, x)
    body = F.transform(turns, lambda x: F.struct(one(x).alias("text"), (x["role"] == OUTPUT).alias("output")))
    piece = lambda s: F.array(F.struct(F.lit(s).alias("text"), F.lit(False).alias("output")))
    out = F.concat(piece(t.preamble), body) if t.preamble else body
    return F.when(F.element_at(turns, -1)["role"] == OUTPUT, out).otherwise(F.concat(out, piece(t.awaiting))) if t.awaiting else out


def _by_role(name: str, x: Column) -> Column:
    out = F.raise_error(F.concat(F.lit(f"{name} has no role "), F.coalesce(x["role"], F.lit("null")))).cast("string")
    for role in TEMPLATES[name].roles:
        given = slots_of(name, role)
        if len(given) == 1:
            out = F.when(x["role"] == role, turn(name, role, **{given[0]: F.coalesce(x["content"], F.lit(""))})).otherwise(out)
    return out


def rendered(name: str, turns: Column) -> Column:
    """The whole dialogue as text, with {bos} and {eos} where the tokenizer's marks belong."""
    t = TEMPLATES[name]
    text = F.array_join(F.transform(dialogue(name, turns), lambda p: p["text"]), "")
    text = F.concat(F.lit(BOS), text) if t.bos else text
    return F.when(F.element_at(turns, -1)["role"] == OUTPUT, F.concat(text, F.lit(EOS))).otherwise(text) if t.eos else text


def encode_dialogues(df: DataFrame, name: str, turns: str, encode: Callable[[Column], Column] = byte_ids, bos: int = 1, eos: int = 2) -> DataFrame:
    """df with input_ids, context_ids, answer_ids and mask of its dialogues.

    The mask is true on output turns; an unanswered dialogue has a context only and null answer and mask. The pieces are
    encoded in a projection of their own, so that each is encoded once.
    """
    t = TEMPLATES[name]
    none = F.array().cast("array<int>")

    def ids(p: Column) -> Column:
        begins, ends = p["text"].startswith(BOS), p["text"].endswith(EOS)
        body = encode(F.regexp_replace(p["text"], r"^\{bos\}|\{eos\}$", ""))
        return F.concat(F.when(begins, F.array(F.lit(bos))).otherwise(none), body, F.when(ends, F.array(F.lit(eos))).otherwise(none))

    pieces = df.withColumn("_p", dialogue(name, F.col(turns))).withColumn("_p", F.transform("_p", lambda p: F.struct(ids(p).alias("ids"), p["output"].alias("output"))))
    answered = F.element_at(turns, -1)["role"] == OUTPUT
    flat = F.flatten(F.transform("_p", lambda p: p["ids"]))
    mask = F.flatten(F.transform("_p", lambda p: F.array_repeat(p["output"], F.size(p["ids"]))))
    last = F.size(F.element_at("_p", -1)["ids"])
    if t.bos:
        flat, mask = F.concat(F.array(F.lit(bos)), flat), F.concat(F.array(F.lit(False)), mask)
    if t.eos:
        flat = F.concat(flat, F.when(answered, F.array(F.lit(eos))).otherwise(none))
        mask, last = F.concat(mask, F.array(F.lit(True))), last + 1
    out = pieces.withColumns({"input_ids": flat, "_last": last, "mask": F.when(answered, mask)})
    cut = F.size("input_ids") - F.col("_last")
    context = F.when(answered, F.slice("input_ids", F.lit(1), cut)).otherwise(F.col("input_ids"))
    answer = F.when(answered, F.slice("input_ids", cut + 1, F.col("_last")))
    return out.withColumns({"context_ids": context, "answer_ids": answer}).select(*df.columns, "input_ids", "context_ids", "answer_ids", "mask")


def with_system(turns: Column, system: str) -> Column:
    """The turns with a system turn first, unless one is there."""
    first = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")))
    return F.when(F.coalesce(F.element_at(turns, 1)["role"], F.lit("")) != "system", F.concat(first, turns)).otherwise(turns)


def split_placeholder(text: Column, placeholders: Sequence[str] = ("<sound>", "<speech>")) -> Column:
    """A turn's text around its first placeholder as structs (kind, value): text, audio, text; blank pieces fall away.

    What follows a second placeholder is left out, as only the pieces beside the first are kept.
    """
    pattern = "|".join(map(re.escape, placeholders))
    pieces = F.split(text, pattern)
    piece = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    whole = F.array(piece("text", text))
    parts = F.array(piece("text", F.trim(F.element_at(pieces, 1))), piece("audio", F.regexp_extract(text, f"({pattern})", 1)), piece("text", F.trim(F.get(pieces, F.lit(1)))))
    return F.when(text.rlike(pattern), F.filter(parts, lambda p: (p["kind"] == "audio") | (F.coalesce(p["value"], F.lit("")) != ""))).otherwise(whole)


def question_prompt(context: str, question: str) -> Column:
    """A reading question with its context."""
    return F.concat(F.lit("Context: "), F.coalesce(F.col(context), F.lit("")), F.lit(" Question: "), F.coalesce(F.col(question), F.lit("")), F.lit(" Answer:"))


def before_marker(text: str, marker: str = "### Output") -> Column:
    """What stands before the marker; the whole text where there is none."""
    return F.substring_index(F.col(text), marker, 1)


def formatted(df: DataFrame, prompt: str, answer: str, ids: Callable[[str], Column]) -> DataFrame:
    """df with what a formatted row has: context_ids, answer_ids, input_ids (both), mask (true on the answer), and the
    lengths input_length, output_length and total_length. ids makes ids of a text column; a null text has none.
    """
    own = lambda c: F.coalesce(ids(c), F.array().cast("array<int>"))
    out = df.withColumns({"context_ids": own(prompt), "answer_ids": own(answer)})
    out = out.withColumns({"input_ids": F.concat("context_ids", "answer_ids"), "mask": F.concat(F.transform("context_ids", lambda _: F.lit(False)), F.transform("answer_ids", lambda _: F.lit(True)))})
    return out.withColumns({"input_length": F.size("context_ids"), "output_length": F.size("answer_ids"), "total_length": F.size("input_ids")})
