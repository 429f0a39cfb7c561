"""Prompt and chat templates as column expressions.

A template is plain text with ``{}`` slots, filled in order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published instruction templates.
ALPACA = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{}\n\n### Input:\n{}\n\n### Response:\n{}"
)
ALPACA_NO_INPUT = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{}\n\n### Response:\n{}"
)
CONTEXT = (
    "Below is an instruction that describes a task, paired with a context for that instruction. "
    "Write a response that appropriately completes the instruction.\n\n"
    "### Instruction:\n{}\n\n### Context:\n{}\n\n### Response:\n{}"
)
MARKED = "### Instruction:\n{}\n### Input:\n{}\n### Output:\n{}"
FENCED = "<s>[INST] {} [/INST] ```python\n{}```</s>"
CHATML_TURN = "<|im_start|>{}\n{}<|im_end|>\n"
QUIZ = "\n\n{}\nA - {}\nB - {}\nC - {}\nD - {}\nThe correct answer is"
LONG_DOCUMENT = (
    "You are given this novel and a multiple choice quiz at the end. "
    "Please read and understand the novel carefully.\n\n=== START ===\n\n{}\n\n=== END ===\n\n"
)


def fill(template: str, *slots: Column) -> Column:
    """Put columns into the ``{}`` slots; a null slot makes the text null."""
    pieces = template.split("{}")
    if len(pieces) != len(slots) + 1:
        raise ValueError(f"template has {len(pieces) - 1} slots, got {len(slots)}")
    parts: list[Column] = [F.lit(pieces[0])]
    for slot, piece in zip(slots, pieces[1:]):
        parts += [slot, F.lit(piece)]
    return F.concat(*parts)


def fill_named(template: str, **slots: Column) -> Column:
    out = F.lit(template)
    for name, value in slots.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def alpaca(instruction: Column, input: Column, output: Column, eos: str = "</s>") -> Column:
    return F.concat(fill(ALPACA, instruction, input, output), F.lit(eos))


def two_branch(instruction: Column, input: Column, output: Column, reference_compat: bool = False) -> Column:
    """The input block only where there is an input.

    `reference_compat` swaps the branches, with a blank after the instruction.
    """
    empty = F.trim(input) == ""
    if reference_compat:
        spaced = ALPACA.replace("### Instruction:\n{}", "### Instruction:\n{} ")
        return F.when(empty, fill(spaced, instruction, input, output)).otherwise(
            fill(ALPACA_NO_INPUT, instruction, output)
        )
    return F.when(empty, fill(ALPACA_NO_INPUT, instruction, output)).otherwise(fill(ALPACA, instruction, input, output))


def with_context(instruction: Column, context: Column, response: Column) -> Column:
    """'' where there is no context, for filtering afterwards."""
    missing = context.isNull() | (context == "")
    return F.when(missing, "").otherwise(fill(CONTEXT, instruction, context, response))


def chatml_turn(role: Column, content: Column) -> Column:
    """One ChatML turn; an empty message renders as ''."""
    blank = content.isNull() | (content == "")
    return F.when(blank, "").otherwise(fill(CHATML_TURN, role, content))


def chatml(messages: Column, generate: bool = False, bos: str = "", eos: str = "") -> Column:
    """A whole `array<struct<role,content>>` as ChatML."""
    turns = F.transform(messages, lambda m: chatml_turn(m["role"], m["content"]))
    tail = "<|im_start|>assistant\n" if generate else ""
    return F.concat(F.lit(bos), F.array_join(turns, ""), F.lit(eos + tail))


def inst_turn(role: Column, content: Column, spaced: bool = True, bos: str = "<s>", eos: str = "</s>") -> Column:
    """One turn in [INST] form: `bos` opens a user turn, `eos` closes an answer.

    `spaced` puts blanks around the answer as the older form does.
    """
    gap = " " if spaced else ""
    user = F.concat(F.lit(f"{bos}[INST] "), F.trim(content), F.lit(" [/INST]"))
    system = F.concat(F.lit("<<SYS>>\n"), F.trim(content), F.lit("\n<</SYS>>\n\n"))
    answer = F.concat(F.lit(gap), content, F.lit(gap + eos))
    return F.when(role == "user", user).when(role == "system", system).when(role == "assistant", answer)


def inst_chat(messages: Column, spaced: bool = True, bos: str = "<s>", eos: str = "</s>") -> Column:
    """A whole chat in [INST] form.

    The newer form opens the text with `bos` once and starts later user turns with a blank.
    """
    if spaced:
        turns = F.transform(messages, lambda m: inst_turn(m["role"], m["content"], True, bos, eos))
        return F.array_join(turns, "")
    turns = F.transform(messages, lambda m: inst_turn(m["role"], m["content"], False, "", eos))
    return F.concat(F.lit(bos), F.replace(F.array_join(turns, ""), F.lit(f"{eos}[INST]"), F.lit(f"{eos} [INST]")))


def history_entry(role: Column, content: Column) -> Column:
    return F.concat(F.lit("### "), role, F.lit(":"), content, F.lit("</s>"))


def system_prompt(system: str, history: str, instruction: str) -> str:
    return f"### System Prompt:\n{system}\n\n{history}\n\n### User Message: {instruction}\n\n### Assistant:"
